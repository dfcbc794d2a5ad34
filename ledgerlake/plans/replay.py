"""Given rows arriving over time, to drive a stream with them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def time_cuts(rows: DataFrame, column: str, parts: int) -> list[Column]:
    """The inner bounds that cut the time range of `column` into `parts` equal ranges."""
    low, high = rows.agg(
        F.min(column).cast("string").alias("low"), F.max(column).cast("string").alias("high")
    ).first()
    if low is None:
        return []
    start = datetime.fromisoformat(low)
    span = datetime.fromisoformat(high) - start
    kind = rows.schema[column].dataType
    # Rounded up to whole microseconds, which leaves each row on its side of the cut.
    moments = [start - (-span * k) // parts for k in range(1, parts)]
    return [F.lit(moment.isoformat(sep=" ")).cast(kind) for moment in moments]


def time_ranges(rows: DataFrame, column: str, parts: int) -> list[Column]:
    """One condition per equal range of time; each row meets exactly one, without a time the last."""
    cuts = time_cuts(rows, column, parts)
    moment = F.col(column)
    conditions = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        condition = F.lit(True)
        if low is not None:
            condition = condition & (moment >= low)
        if high is not None:
            condition = condition & (moment < high)
        elif low is not None:
            condition = condition | moment.isNull()
        conditions.append(condition)
    return conditions


Arrival = TypeVar("Arrival")


def arrive(
    arrivals: Iterable[Arrival],
    land: Callable[[Arrival], None],
    run: Callable[[], StreamingQuery],
) -> None:
    """Land one arrival after the other; after each, run the stream until it has caught up.

    Every run continues from the checkpoint of the one before, as a restarted job does.
    """
    for arrival in arrivals:
        land(arrival)
        run().awaitTermination()
