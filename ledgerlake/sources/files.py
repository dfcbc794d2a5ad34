"""File sources, batch and stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import MESSAGE, STORED_TRANSACTION

# Fixed value: a rate limit (files per micro-batch) to choose.
FILES_PER_BATCH = 1

# The column of a table with a directory per day.
DAY = "transaction_date"

TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet directory; the output of a streaming file sink is read by its commit log."""
    return spark.read.parquet(path)


def read_days(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The days from `first` to `last` of a table with a directory per day; no other is read."""
    rows, day = read_parquet(spark, path), F.col(DAY)
    if first is not None:
        rows = rows.where(day >= F.lit(first))
    if last is not None:
        rows = rows.where(day <= F.lit(last))
    return rows


def load(spark: SparkSession, path: str) -> DataFrame:
    """A directory in the session's default format."""
    return spark.read.load(path)


def read_transactions_csv(
    spark: SparkSession, path: str, schema: str = STORED_TRANSACTION
) -> DataFrame:
    """Transactions as CSV with a header line; a field that does not fit its type is null."""
    return (
        spark.read.format("csv")
        .schema(schema)
        .options(header=True, timestampFormat=TIMESTAMP_TEXT)
        .load(path)
    )


def json_stream(
    spark: SparkSession,
    path: str,
    schema: str = STORED_TRANSACTION,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Transactions arriving as JSON files, all that are there or so many per micro-batch."""
    reader = spark.readStream.format("json").schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def message_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages arriving as Parquet files with the topic's binary `value` column."""
    reader = spark.readStream.format("parquet").schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
