"""The state of a stopped stream, read as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.fraud import COUNT, DAILY_KEYS
from ledgerlake.streaming.jobs import LARGE_STATE, set_for


def stored_state(spark: SparkSession, checkpoint: str, state=LARGE_STATE) -> DataFrame:
    """key and value of each group that a query with one stateful operator keeps, after its last batch."""
    with set_for(spark, state):
        rows = spark.read.format("statestore").load(checkpoint)
        return rows.select("key", "value")


def open_days(spark: SparkSession, checkpoint: str, state=LARGE_STATE) -> DataFrame:
    """The senders' days that `jobs.watch_fraud` still keeps, as late rows may change them, and their counts.

    Only for a job with a `lateness`, whose days are windows.
    """
    rows = stored_state(spark, checkpoint, state)
    kinds = rows.schema["key"].dataType
    window = next(field.name for field in kinds.fields if "struct" in field.dataType.simpleString())
    sender, day = F.col(f"key.{kinds.fields[0].name}"), F.to_date(F.col("key")[window]["start"])
    count = F.col("value.count").alias(COUNT)
    return rows.select(sender.alias(DAILY_KEYS[0]), day.alias(DAILY_KEYS[1]), count)
