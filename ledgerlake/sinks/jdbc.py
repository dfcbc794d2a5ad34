"""Result tables in a database, written by the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.sources.jdbc import Connection

WRITERS = 16
ROWS_PER_INSERT = 10_000


def _writer(df: DataFrame, connection: Connection, table: str, writers: int):
    return (
        df.write.format("jdbc")
        .options(**connection.options())
        .option("dbtable", table)
        .option("numPartitions", writers)
        .option("batchsize", ROWS_PER_INSERT)
    )


def overwrite_table(
    df: DataFrame,
    connection: Connection,
    table: str,
    keep_definition: bool = True,
    writers: int = WRITERS,
) -> None:
    """Replace the rows of a result table over at most `writers` connections.

    With `keep_definition` the table is emptied, which keeps its indexes and grants; without,
    it is dropped and created anew, as a report with new pivot columns needs.
    """
    writer = _writer(df, connection, table, writers).option("truncate", keep_definition)
    writer.mode("overwrite").save()


def batch_appender(
    connection: Connection, table: str, writers: int = WRITERS
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that appends each micro-batch with its `batch_id`.

    An updating stream sends a key again whenever it changes, and a retried batch is appended
    again: readers take each key's row with the greatest `batch_id`. Errors are raised, so that
    Spark retries the batch.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        _writer(rows, connection, table, writers).mode("append").save()

    return append
