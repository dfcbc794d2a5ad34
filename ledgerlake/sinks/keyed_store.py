"""Rows to a key-value store, written from the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row

ROWS_PER_WRITE = 500


def batch_upserter(
    put_many: Callable[[Iterable[tuple[str, dict]]], None],
    key: str,
    fields: list[str],
    rows_per_write: int = ROWS_PER_WRITE,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that puts each row's fields under its key.

    `put_many` runs in the tasks; it gets (key, fields) pairs and must replace what a key held,
    so that a retried task or batch leaves the store as it was. Errors are raised.
    """

    def send(rows: Iterator[Row]) -> None:
        pairs = ((row[key], {name: row[name] for name in fields}) for row in rows)
        while chunk := list(islice(pairs, rows_per_write)):
            put_many(chunk)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.select(key, *fields).foreachPartition(send)

    return upsert
