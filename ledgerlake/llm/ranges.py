"""Rows dealt in ranges, so that an order over all of them needs no task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import stored

_PART = 33  # bits of monotonically_increasing_id below the number of the partition


def in_order(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The rows, stored in ascending order of the columns (nulls first), with their place `_at`.

    Rows are dealt by ranges; rows that are equal in all the columns are dealt out too, so that no
    value makes a large task. Places grow with the order, with gaps between the ranges.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = [*by, "_tie"]
    dealt = (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *whole)
        .sortWithinPartitions(*whole)
        .drop("_tie")
    )
    return stored(dealt.withColumn("_at", F.monotonically_increasing_id()), name)


def part_of(at: str = "_at") -> Column:
    """The number of the range that a place is in."""
    return F.shiftright(at, _PART)
