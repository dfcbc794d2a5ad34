"""Python workers, which Spark keeps for later tasks: what a task has used goes back when it ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return what is no longer used to the system; the allocators would keep it for the worker.

    Else an executor would hold the most that any task before needed, also while others run.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow, giving back at its end."""

    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task


def lean_group(meet: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`meet` for applyInArrow, giving back after each group."""

    def task(rows: pa.Table) -> pa.Table:
        found = meet(rows)
        give_back()
        return found

    return task
