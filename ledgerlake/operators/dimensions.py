"""The account dimension: accounts with the attributes of their customers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import income_category
from ledgerlake.operators.lookups import BROADCAST_LIMIT, left_lookup
from ledgerlake.schemas import CUSTOMER_ACCOUNT_COLUMNS


def customer_accounts(
    accounts: DataFrame, customers: DataFrame, broadcast_limit: int | None = BROADCAST_LIMIT
) -> DataFrame:
    """Every account, with its customer's attributes where the customer is known."""
    attributes = customers.select(
        F.col("id"), "full_name", "income", "customer_segment", "occupation", "is_vip"
    )
    joined = left_lookup(accounts, attributes, F.col("customer_id"), "id", broadcast_limit)
    return joined.select(*CUSTOMER_ACCOUNT_COLUMNS)


def with_income_category(rows: DataFrame) -> DataFrame:
    return rows.withColumn("income_category", income_category(F.col("income")))


def account_ids_repeat(cust_accounts: DataFrame) -> bool:
    """Whether any account id occurs twice, so that a join on it would repeat facts."""
    ids = cust_accounts.select("account_id").where(F.col("account_id").isNotNull())
    repeated = ids.groupBy("account_id").count().where(F.col("count") > 1)
    return not repeated.isEmpty()


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a dimension that several reports share in memory, and let it go afterwards."""
    df.cache()
    try:
        yield df
    finally:
        df.unpersist()
