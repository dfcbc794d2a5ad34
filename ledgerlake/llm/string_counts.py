"""Counts of strings of words, by hash, of those that occur more than once.

Most strings of a corpus occur once. They are told apart first: each task sends the distinct hashes of
its strings, packed by slices of the hash space, and what a slice receives twice becomes a bit. Only
strings with a bit are then sent with their parts and counted. A slice has some `SLICE` strings
whatever the size of the corpus, and a frequent string reaches it once from each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.workers import lean, lean_group

#: Strings that a task looks at before it sends what it has.
TOKENS = 1 << 21
#: Strings for which there is a slice of the hash space.
SLICE = 1 << 21
#: Slices that a task sends at once.
AT_ONCE = 4
#: Bits that tell which strings repeat: as many as there are tokens, at most 2 ** 30 (128 MB).
FEWEST, MOST = 20, 30

#: Of some record batches, one group of texts after the other: front, back and whole hash of strings;
#: only the last of them matters to `repeated`.
Strings = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]


class Repeated(NamedTuple):
    """Bits of the strings that occur more than once, by the first bits of their hashes; strings that
    occur once may have one too."""

    bits: int
    set: np.ndarray

    def may(self, whole: np.ndarray) -> np.ndarray:
        at = (whole >> np.uint64(64 - self.bits)).astype(np.int64)
        return ((self.set[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def slice_bits(tokens: int) -> int:
    """Bits of the number of a slice."""
    return max(0, (tokens // SLICE).bit_length())


def in_order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the values in ascending order, and where a new value begins among these."""
    order = np.argsort(values)
    values = values[order]
    return order, np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def _edges(sorted_values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slices that some values lie in, and the bounds of each among the values."""
    part = (sorted_values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_values), np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return part[first], np.append(first, len(part))


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The values between the edges, as bytes."""
    offsets = pa.py_buffer((edges * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), kind)


def _few_at_once(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, AT_ONCE) for at in range(0, batch.num_rows, AT_ONCE))


def _gathered(found: Iterator, tokens: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Some groups taken together, until they have so many strings."""
    held, size = [], 0
    for part in found:
        if len(part[0]):
            held.append(part)
            size += len(part[0])
        if size >= tokens:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def repeated(texts: DataFrame, strings: Strings, tokens: int, least: int = 2) -> Repeated:
    """Which strings of the texts occur `least` times or more. `tokens`: about how many there are.

    Within a slice, 32 bits of the hash tell strings apart; equal bits let a string through that
    occurs less often, and never keep one back. A task sends a string at most `least` times.
    """
    low = slice_bits(tokens)
    bits = min(MOST, max(FEWEST, low, tokens.bit_length()))

    def send(batches):
        for *_, whole in _gathered(strings(batches), TOKENS):
            whole = np.sort(whole)
            enough = np.append(np.zeros(least, bool), whole[least:] == whole[:-least])[: len(whole)]
            whole = whole[~enough]
            part, edges = _edges(whole, low)
            inside = ((whole << np.uint64(low)) >> np.uint64(32)).astype(np.uint32)
            columns = [pa.array(part), _packed(inside, edges)]
            yield from _few_at_once(pa.record_batch(columns, names=["slice", "seen"]))

    def meet(rows: pa.Table) -> pa.Table:
        seen = np.sort(_unpacked(rows["seen"], np.uint32))
        found = seen[least - 1 :][seen[least - 1 :] == seen[: len(seen) - least + 1]]
        marks = np.zeros(max(8, 1 << (bits - low)), bool)
        marks[found >> np.uint32(32 - (bits - low))] = True
        return pa.table({"slice": rows["slice"][:1], "set": pa.array([np.packbits(marks, bitorder="little").tobytes()])})

    rows = texts.mapInArrow(lean(send), "slice long, seen binary")
    met = rows.groupBy("slice").applyInArrow(lean_group(meet), "slice long, set binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = len(out) >> low
    for row in met.coalesce(1 << low).toLocalIterator():  # a job for each partition: not more than slices
        out[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row["set"], np.uint8)
    return Repeated(bits, out)


def counts(texts: DataFrame, strings: Strings, tokens: int, whole_of: Callable, least: int) -> DataFrame:
    """front, back, key, n: the strings that occur at least `least` times, by the hashes of the string
    without its last and without its first word; `whole_of` gives the string's (key) from these."""
    low = slice_bits(tokens)

    def added(whole, front, back, n):
        """Each string once, by ascending hash, with its number."""
        order, first = in_order(whole)
        to = order[first]
        return whole[to], front[to], back[to], np.add.reduceat(n[order], first)

    def send(batches):
        for front, back, whole in _gathered(strings(batches), TOKENS):
            whole, front, back, n = added(whole, front, back, np.ones(len(whole), np.int64))
            part, edges = _edges(whole, low)
            columns = [_packed(v, edges) for v in (front, back, n.astype(np.uint32))]
            yield from _few_at_once(pa.record_batch([pa.array(part), *columns], names=["slice", "front", "back", "n"]))

    def meet(rows: pa.Table) -> pa.Table:
        front, back = _unpacked(rows["front"], np.uint64), _unpacked(rows["back"], np.uint64)
        n = _unpacked(rows["n"], np.uint32).astype(np.int64)
        whole, front, back, n = added(whole_of(front, back), front, back, n)
        often = n >= least
        signed = [v[often].view(np.int64) for v in (front, back, whole)]
        return pa.table([*map(pa.array, signed), pa.array(n[often])], names=["front", "back", "key", "n"])

    rows = texts.mapInArrow(lean(send), "slice long, front binary, back binary, n binary")
    return rows.groupBy("slice").applyInArrow(lean_group(meet), "front long, back long, key long, n long")
