"""Transactions joined with the account dimension of their sender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import account_key, total
from ledgerlake.operators.dimensions import account_ids_repeat
from ledgerlake.operators.lookups import BROADCAST_LIMIT, SALT_BUCKETS, left_lookup


def enrich_transactions(
    transactions: DataFrame,
    cust_accounts: DataFrame,
    broadcast_limit: int | None = BROADCAST_LIMIT,
    salt_buckets: int = SALT_BUCKETS,
    known_bytes: int | None = None,
) -> DataFrame:
    """Every transaction, with its sender's account and customer where known."""
    key = account_key(F.col("sender_account_id"))
    return left_lookup(
        transactions, cust_accounts, key, "account_id", broadcast_limit, salt_buckets, known_bytes
    )


def counted_transactions(
    transactions: DataFrame, cust_accounts: DataFrame, repeat: bool | None = None
) -> DataFrame:
    """The rows of the enriched transactions, for reports that read no dimension column.

    A left join on an id that occurs once keeps each transaction exactly once, so the join is
    left out after a check on the dimension alone, unless the caller knows its outcome. Where
    an id does `repeat`, the join is made.
    """
    if repeat is None:
        repeat = account_ids_repeat(cust_accounts)
    return enrich_transactions(transactions, cust_accounts) if repeat else transactions


def repeat_by_account(
    transactions: DataFrame, cust_accounts: DataFrame, salt_buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Every transaction as often as a left join with the accounts by its sender would give it.

    Only the account ids that occur more than once are joined; without any, nothing is.
    """
    key = account_key(F.col("sender_account_id"))
    return repeat_by_key(transactions, key, cust_accounts, "account_id", salt_buckets)


def repeat_by_key(
    facts: DataFrame,
    fact_key: Column,
    dimension: DataFrame,
    dimension_key: str,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Every fact as often as a left join with the dimension would give it, without its columns."""
    known = dimension.where(F.col(dimension_key).isNotNull()).groupBy(dimension_key)
    repeated = known.agg(F.count("*").alias("copies")).where("copies > 1")
    if repeated.isEmpty():
        return facts
    joined = left_lookup(facts, repeated, fact_key, dimension_key, salt_buckets=salt_buckets)
    copies = F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))
    return joined.withColumn("copies", F.explode(copies)).drop("copies", dimension_key)


def sender_totals(transactions: DataFrame, cust_accounts: DataFrame, *attributes: str) -> DataFrame:
    """Per sender amount and count, with the named attributes of the sender's account.

    Sums and counts split over the join, so transactions are reduced to one row per sender
    before they meet the dimension: a hot sender shrinks to one row per task before the shuffle,
    and that shuffle, on the account number, already serves the join.
    """
    totals = (
        transactions.select(
            account_key(F.col("sender_account_id")).alias("sender_key"), F.col("amount")
        )
        .groupBy("sender_key")
        .agg(total(transactions, "amount").alias("amount_sum"), F.count("amount").alias("amount_count"))
    )
    dimension = cust_accounts.select("account_id", *attributes)
    joined = left_lookup(
        totals, dimension, F.col("sender_key"), "account_id", broadcast_limit=None
    )
    return joined.select(*attributes, "amount_sum", "amount_count")
