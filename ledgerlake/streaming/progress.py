"""What a stream tells of its micro-batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql.streaming import StreamingQuery


class Batch(NamedTuple):
    number: int
    rows: int  # rows that it read
    counts: Mapping[str, int]  # what was observed of them


def batches(query: StreamingQuery, observation: str | None = None) -> list[Batch]:
    """The micro-batches that read rows, of the last ones that Spark keeps in mind for a query
    (`spark.sql.streaming.numRecentProgressUpdates`)."""
    found = []
    for progress in query.recentProgress:
        counts = progress.observedMetrics.get(observation)
        if progress.numInputRows:
            told = {} if counts is None else counts.asDict()
            found.append(Batch(progress.batchId, progress.numInputRows, told))
    return found


def totals(found: list[Batch]) -> Counter[str]:
    """The observed counts of some micro-batches together."""
    total: Counter[str] = Counter()
    for batch in found:
        total.update(batch.counts)
    return total
