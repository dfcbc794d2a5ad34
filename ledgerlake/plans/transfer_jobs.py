"""Batch jobs between a database, the Parquet tables and the transaction topic.

They need a JDBC driver and, to publish, Spark's Kafka connector on the classpath.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from ledgerlake.operators.messages import to_messages
from ledgerlake.schemas import ACCOUNT_COLUMNS, CUSTOMER_COLUMNS, TRANSACTION_COLUMNS
from ledgerlake.sinks.files import snapshot
from ledgerlake.sinks.kafka import publish
from ledgerlake.sources.jdbc import Connection, measure_split, read_table

# Side-by-side connections of one read.
READERS = 16


def snapshot_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    key: str,
    path: str,
    columns: Sequence[str] | None = None,
    readers: int = READERS,
) -> None:
    """Copy a table over its last snapshot, read in ranges of its key."""
    split = measure_split(spark, connection, table, key, readers)
    snapshot(read_table(spark, connection, table, columns, split), path)


def snapshot_dimensions(
    spark: SparkSession, connection: Connection, path: str, schema: str = "public"
) -> None:
    """Snapshot the customers and the accounts below `path`."""
    wanted = {"customers": ("id", CUSTOMER_COLUMNS), "accounts": ("account_id", ACCOUNT_COLUMNS)}
    for name, (key, columns) in wanted.items():
        snapshot_table(spark, connection, f"{schema}.{name}", key, f"{path}/{name}", columns)


def publish_transactions(
    spark: SparkSession,
    connection: Connection,
    servers: str,
    topic: str,
    login: Mapping[str, str] | None = None,
    table: str = "public.transactions",
    readers: int = READERS,
) -> None:
    """Send every transaction of the table as a message; a second run sends them all again."""
    split = measure_split(spark, connection, table, "transaction_id", readers)
    rows = read_table(spark, connection, table, TRANSACTION_COLUMNS, split)
    publish(to_messages(rows), servers, topic, login)
