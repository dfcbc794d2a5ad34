"""The data model read from the given star-schema tables.

Customers, accounts and transactions of a bank are derived column by column from the tables of
a shop: an order's customer sends a transaction for each of its line items; events are the
transactions of the streams. Ids are as wide as the keys they come from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import money
from ledgerlake.operators.enrichment import repeat_by_key
from ledgerlake.schemas import (
    ACCOUNT_COLUMNS,
    CUSTOMER_COLUMNS,
    MONEY,
    TRANSACTION_COLUMNS,
)
from ledgerlake.sources.files import load, read_parquet

# Domains of the pivoted columns in the given tables.
BATCH_TYPES = ["A", "N", "R"]
OCCUPATIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "null"]
PRODUCTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


# The keys by which transactions look up their sender, product and location.
LOOKUP_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, _path(sf_dir, name))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    rows = (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("c_custkey")
    balance = money(F.col("c_acctbal"))
    return rows.withColumns(
        {
            "id": key,
            "username": F.concat(F.lit("user"), key),
            "full_name": F.col("c_name"),
            "date_of_birth": _days_after("1950-01-01", key % 20000),
            "gender": F.when(key % 2 == 0, "F").otherwise("M"),
            "marital_status": F.when(key % 3 == 0, "single").when(key % 3 == 1, "married"),
            "nationality": F.col("n_name"),
            "occupation": F.col("r_name"),
            "education_level": F.concat(F.lit("level "), key % 5),
            "income": F.when(key % 10 != 0, ((balance + 1000) * 10).cast("decimal(12,2)")),
            "phone_number": F.concat(F.lit("555-"), key),
            "address": F.concat(key, F.lit(" Main Street")),
            "email": F.concat(F.lit("user"), key, F.lit("@example.com")),
            "date_joined": _days_after("2015-01-01", key % 2000),
            "loan_approval_status": F.when(key % 4 == 0, "approved").when(key % 4 == 1, "rejected"),
            "loan_amount": F.when(key % 4 == 0, balance),
            "customer_segment": F.col("c_mktsegment"),
            "is_vip": F.col("c_acctbal") > 9000,
        }
    ).select(*CUSTOMER_COLUMNS)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    balance = money(F.col("c_acctbal"))
    owner = F.when(key % 20 != 7, key - key % 2)
    return (
        load(spark, _path(sf_dir, "customer"))
        .withColumns(
            {
                # Some senders have no account: these accounts have ids that no sender uses.
                "account_id": F.when(key % 25 != 3, key).otherwise(-key),
                "customer_id": owner,
                "is_active": key % 11 != 0,
                "initial_balance": (balance + 100).cast(MONEY),
                "date_opened": F.lit("2020-01-01").cast("date"),
                "date_closed": F.when(key % 11 == 0, F.lit("2024-01-01").cast("date")),
                "current_balance": balance,
            }
        )
        .select(*ACCOUNT_COLUMNS)
    )


def transactions(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = TRANSACTION_COLUMNS
) -> DataFrame:
    """The transactions of the batch reports, with the wanted columns.

    Sender, product and location come from other tables, whose keys are unique; each is looked
    up only where it is wanted, and a missing one leaves null, so the rows stay the same.
    """
    rows = _table(spark, sf_dir, "lineitem")
    if "sender_account_id" in columns:
        orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "product_name" in columns:
        part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "location" in columns:
        supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        rows = rows.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    stored = {
        "transaction_id": lambda: (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("string"),
        "timestamp": lambda: F.col("l_shipdate").cast("timestamp"),
        "transaction_type": lambda: F.col("l_returnflag"),
        "sender_account_id": lambda: _text("o_custkey"),
        "receiver_account_id": lambda: _text("l_suppkey"),
        "amount": lambda: money(F.col("l_extendedprice")),
        "transaction_fee": lambda: money(F.col("l_tax") * 100),
        "subtype": lambda: F.col("l_linestatus"),
        "device_type": lambda: F.concat(F.lit("device "), "l_linenumber"),
        "location": lambda: F.col("n_name"),
        "product_name": lambda: F.col("p_type"),
        "product_amount": lambda: money(F.col("l_quantity")),
        "transaction_message": lambda: F.lit(None).cast("string"),
    }
    keys = {name: lambda name=name: F.col(name) for name in LOOKUP_KEYS}
    return rows.select(*[(stored | keys)[name]().alias(name) for name in columns])


def whole_transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wanted columns of the transactions with all columns, row for row.

    A key that occurs twice in a table that is looked up repeats the rows of its transactions, also
    where nothing of that table is wanted; then only such keys are joined, and usually there are none.
    """
    rows = transactions(spark, sf_dir, columns + LOOKUP_KEYS)
    suppliers, nations = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
    lookups = {
        "sender_account_id": (_table(spark, sf_dir, "orders"), "o_orderkey", "l_orderkey"),
        "product_name": (_table(spark, sf_dir, "part"), "p_partkey", "l_partkey"),
        "location": (
            suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left"),
            "s_suppkey",
            "l_suppkey",
        ),
    }
    for column, (table, table_key, row_key) in lookups.items():
        if column not in columns:
            rows = repeat_by_key(rows, F.col(row_key), table, table_key)
    return rows.select(*columns)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def event_transactions(rows: DataFrame) -> DataFrame:
    """Events, batch or stream, as the transactions of the streams."""
    value = money(F.col("value"))
    nothing = F.lit(None).cast("string")
    return rows.select(
        _text("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("transaction_type"),
        _text("user_id").alias("sender_account_id"),
        nothing.alias("receiver_account_id"),
        (value * 100).cast(MONEY).alias("amount"),
        value.alias("transaction_fee"),
        nothing.alias("subtype"),
        nothing.alias("device_type"),
        nothing.alias("location"),
        nothing.alias("product_name"),
        F.lit(None).cast(MONEY).alias("product_amount"),
        F.col("props").alias("transaction_message"),
    )
