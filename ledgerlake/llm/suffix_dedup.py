"""Removal of byte strings that occur more than once, by ranks of positions at doubled lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.bitmaps import collect_bitmap, in_bitmap
from ledgerlake.llm.tables import carried, drop_stored, release, stored

#: Bytes that are ranked together, and bytes of one long text in one step: their ranks stay in a
#: processor's cache.
STEP = 1 << 16
#: Bits that are looked at to tell the rows that stand for their class.
LEAD_PROBES = 3
#: Rows that a task gathers before it hands them on.
ROWS = 100_000

# Any odd numbers with well-mixed bits do.
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LETTER = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Plan(NamedTuple):
    """Lengths that follow from the threshold.

    gram: the length of the first ranks, a power of two. window: grams of which the smallest rank
    is an anchor; a window spans `span` bytes, so every string of `length` bytes has whole windows.
    """

    length: int

    @property
    def gram(self) -> int:
        return 1 << max(0, (self.length // 6).bit_length() - 1)

    @property
    def window(self) -> int:
        return max(1, (self.length - self.gram + 1) * 3 // 8)

    @property
    def span(self) -> int:
        return self.window + self.gram - 1


class Step(NamedTuple):
    """Parts of texts, one behind the other in `data`; part k begins at `starts[k]`.

    Part k is what `texts[k]` holds from `offsets[k]` on. Its positions from `own_from[k]` up to
    `own_to[k]` (in `data`) belong to this step; those around them only to the neighbours of it.
    """

    data: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    offsets: np.ndarray
    own_from: np.ndarray
    own_to: np.ndarray


def steps(batch: pa.RecordBatch, leads: np.ndarray, margin: int) -> Iterator[Step]:
    """The texts of a batch (text class, mark, bytes) whose class and mark are in `leads`, as steps."""
    held, size = [], 0
    cls = batch.column(0).to_numpy(zero_copy_only=False)
    mark = batch.column(1).to_numpy(zero_copy_only=False)
    for k in np.flatnonzero(in_bitmap(leads, (cls ^ mark).view(np.uint64), LEAD_PROBES)):
        text = np.frombuffer(batch.column(2)[k].as_buffer(), np.uint8)
        for at in range(0, len(text), STEP):
            first, last = max(0, at - margin), min(len(text), at + STEP + margin)
            own_to = min(len(text), at + STEP) - first
            held.append((cls[k], text[first:last], first, at - first, own_to))
            size += last - first
            if size >= STEP:
                yield _step(held)
                held, size = [], 0
    if held:
        yield _step(held)


def _step(held: list[tuple]) -> Step:
    sizes = np.array([len(part) for _, part, _, _, _ in held])
    starts = np.cumsum(sizes) - sizes
    column = lambda k: np.array([h[k] for h in held])
    return Step(
        np.concatenate([h[1] for h in held]),
        column(0).astype(np.int64),
        starts,
        column(2),
        starts + column(3),
        starts + column(4),
    )


class Ranks:
    """Ranks and anchors of one step. Ranks are hash values: equal strings have equal ranks."""

    def __init__(self, step: Step, plan: Plan):
        self.step, self.plan = step, plan
        n = len(step.data)
        self.part = np.repeat(np.arange(len(step.starts)), np.diff([*step.starts, n]))
        self.end = np.append(step.starts[1:], n)[self.part]
        rank, size = _LETTER[step.data], 1
        while size < plan.gram:
            rank, size = self._doubled(rank, size, size), 2 * size
        self.gram = _mixed(rank)
        low = np.uint64((1 << 21) - 1)
        here = np.arange(len(self.gram), dtype=np.uint64)
        # Equal ranks: the rightmost is the smallest.
        smallest = self._smallest((self.gram & ~low) | (low - here), plan.window)
        self.chosen = (low - (smallest & low)).astype(np.int64)
        whole = np.arange(len(self.chosen)) + plan.span <= self.end[: len(self.chosen)]
        places = self.chosen[whole]
        self.anchors = places[np.append(True, places[1:] != places[:-1])] if len(places) else places

    @staticmethod
    def _doubled(rank: np.ndarray, size: int, offset: int) -> np.ndarray:
        """The ranks of strings of size + offset bytes, from the pairs of ranks `offset` apart."""
        odd = np.uint64(pow(int(_A), size, 1 << 64))
        return rank[: max(0, len(rank) - offset)] * odd + rank[offset:]

    @staticmethod
    def _smallest(values: np.ndarray, window: int) -> np.ndarray:
        """The smallest value of each window of consecutive ones."""
        size = 1
        while 2 * size <= window:
            values = np.minimum(values[: max(0, len(values) - size)], values[size:])
            size *= 2
        rest = window - size
        return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values

    def full(self) -> np.ndarray:
        """The rank at the threshold's length of each position (meaningless across parts)."""
        rank, size, length = self.gram, self.plan.gram, self.plan.length
        while 2 * size <= length:
            rank, size = self._doubled(rank, size, size), 2 * size
        return _mixed(self._doubled(rank, size, length - size) if size < length else rank)

    def owned(self, places: np.ndarray) -> np.ndarray:
        part = self.part[places]
        return (places >= self.step.own_from[part]) & (places < self.step.own_to[part])

    def cls_and_offset(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = self.part[places]
        return self.step.texts[part], places - self.step.starts[part] + self.step.offsets[part]

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Whether each position may begin a repeated string: the anchors of all windows inside it
        are strings that occur more than once (`repeated`: their bitmap)."""
        n, length, span = len(self.step.data), self.plan.length, self.plan.span
        out = np.zeros(n, bool)
        if len(self.chosen) == 0 or n < length:
            return out
        change = np.append(0, np.flatnonzero(np.diff(self.chosen)) + 1)
        known = in_bitmap(repeated, self.gram[self.chosen[change]])
        single = np.repeat(~known, np.diff(np.append(change, len(self.chosen))))
        count = np.append(0, np.cumsum(single))
        inside = length - span + 1
        m = n - length + 1
        out[:m] = (count[inside : inside + m] - count[:m] == 0) & (
            np.arange(m) + length <= self.end[:m]
        )
        return out

    def blocks(self, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block of each position, first and last position of the blocks of candidates only).

        A block goes from an anchor up to the next, so equal passages have equal blocks but at
        their ends. Blocks with other positions than candidates have first -1.
        """
        n = len(candidate)
        begins = np.zeros(n, bool)
        begins[self.anchors] = True
        begins[self.step.starts] = True
        first = np.flatnonzero(begins)
        block = np.cumsum(begins) - 1
        last = np.append(first[1:], n) - 1
        count = np.add.reduceat(candidate, first, dtype=np.int64)
        return block, np.where(count == last - first + 1, first, -1), last


def _block_rank(full: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Ranks of the strings from a block's first to its last position and the threshold's length on:
    the two ranks at its ends overlap, as no block is longer than the threshold."""
    return _mixed(full[first] * _A + full[last] * _C + (last - first).astype(np.uint64))


def _occurrence(cls: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return _mixed(cls.view(np.uint64) * _A + offset.astype(np.uint64))


class Texts(NamedTuple):
    """Texts (cls long, mark long, raw binary) and a bitmap of what leads each class of equal ones:
    its class XOR its mark. Others are passed over."""

    rows: DataFrame
    leads: Broadcast


def _each_step(texts: Texts, plan: Plan, schema: str, rows) -> DataFrame:
    """rows(ranks) for every step of every leading text: columns of `schema` as arrays, or None."""
    names = [field.split()[0] for field in schema.split(", ")]
    leads = texts.leads

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for step in steps(batch, leads.value, 4 * plan.length):
                columns = rows(Ranks(step, plan))
                if columns is None:
                    continue
                held.append(columns)
                size += len(columns[0])
                if size >= ROWS:
                    yield _gathered(held, names)
                    held, size = [], 0
        if held:
            yield _gathered(held, names)

    return texts.rows.mapInArrow(run, schema)


def _gathered(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    signed = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
    return pa.record_batch([pa.array(c) for c in signed], names=names)


def _anchors(texts: Texts, plan: Plan) -> DataFrame:
    def rows(ranks: Ranks):
        return (ranks.gram[ranks.anchors[ranks.owned(ranks.anchors)]],)

    return _each_step(texts, plan, "rank long", rows)


def _block_rows(texts: Texts, plan: Plan, repeated) -> DataFrame:
    def rows(ranks: Ranks):
        _, first, last = ranks.blocks(ranks.candidates(repeated.value))
        keep = np.flatnonzero(first >= 0)
        keep = keep[ranks.owned(first[keep])]
        if not len(keep):
            return None
        first, last = first[keep], last[keep]
        cls, offset = ranks.cls_and_offset(first)
        end = offset + (last - first) + plan.length
        return (
            _block_rank(ranks.full(), first, last),
            _occurrence(cls, offset),
            cls,
            offset.astype(np.int32),
            end.astype(np.int32),
        )

    schema = "rank long, occurrence long, cls long, first int, end int"
    return _each_step(texts, plan, schema, rows)


def _position_rows(texts: Texts, plan: Plan, repeated, alone, leading, again=None) -> DataFrame:
    """Single positions: candidates outside whole blocks, or in blocks of the bitmaps `alone` or
    `leading`. Their ranks; with `again`, also cls and first of those whose rank may be in it."""

    def rows(ranks: Ranks):
        candidate = ranks.candidates(repeated.value)
        if not candidate.any():
            return None
        full = ranks.full()
        block, first, last = ranks.blocks(candidate)
        whole = np.flatnonzero(first >= 0)
        asked = first < 0
        if len(whole):
            mark = _block_rank(full, first[whole], last[whole])
            mark ^= _occurrence(*ranks.cls_and_offset(first[whole]))
            asked[whole] = in_bitmap(alone.value, mark) | in_bitmap(leading.value, mark)
        places = np.flatnonzero(candidate & asked[block])
        places = places[ranks.owned(places)]
        if again is None:
            return (full[places],)
        places = places[in_bitmap(again.value, full[places])]
        cls, offset = ranks.cls_and_offset(places)
        return full[places], cls, offset.astype(np.int32)

    schema = "rank long" if again is None else "rank long, cls long, first int"
    return _each_step(texts, plan, schema, rows)


def repeated_spans(texts: Texts, length: int) -> DataFrame:
    """cls, blocks (array of first, end: bytes) and places (array of int: where strings begin) that
    cover what occurs more than once in the leading texts, not merged.

    Ranks double within a task: the rank of 2n bytes is that of the pair of ranks n bytes apart.
    Between doublings the positions meet in Spark, and those whose rank is unique go:

    1. at `Plan.gram` bytes, only anchors meet: of each window the gram of smallest rank, so that
       each repeated string holds the same anchors wherever it is;
    2. at the threshold's length and up to one window more, whole blocks of positions between
       anchors meet as one row each;
    3. at the threshold's length, single positions meet: those at the ends of passages, which make
       no whole block, those of blocks that occur once, and those of one occurrence of each other
       block. First their ranks alone are counted, then the places of those counted twice.
    """
    plan = Plan(length)
    spark = texts.rows.sparkSession
    sc = spark.sparkContext

    grams = _anchors(texts, plan).groupBy("rank").count().where("count > 1").select("rank")
    grams = stored(grams, "repeats-grams")
    repeated = sc.broadcast(collect_bitmap(grams, "rank"))
    drop_stored(grams)
    release(spark)

    blocks = stored(_block_rows(texts, plan, repeated), "repeats-blocks")
    groups = blocks.groupBy("rank").agg(F.min("occurrence").alias("low"), F.count("rank").alias("n"))
    groups = stored(groups, "repeats-groups")
    marks = groups.withColumn("mark", F.col("rank").bitwiseXOR(F.col("low")))
    alone = sc.broadcast(collect_bitmap(marks.where("n = 1"), "mark"))
    leading = sc.broadcast(collect_bitmap(marks.where("n > 1"), "mark"))
    found = blocks.join(groups.where("n > 1").select("rank"), "rank", "left_semi")
    found = found.groupBy("cls").agg(F.collect_list(F.struct("first", "end")).alias("blocks"))
    from_blocks = stored(found, "repeats-from-blocks")
    drop_stored(blocks)
    drop_stored(groups)
    release(spark)

    known = texts, plan, repeated, alone, leading
    again = _position_rows(*known).groupBy("rank").count().where("count > 1").select("rank")
    again = stored(again, "repeats-again")
    bitmap = sc.broadcast(collect_bitmap(again, "rank"))
    release(spark)

    places = _position_rows(*known, bitmap).join(again, "rank", "left_semi")
    from_places = places.groupBy("cls").agg(F.collect_list("first").alias("places"))
    spans = stored(from_blocks.join(from_places, "cls", "full"), "repeats-spans")
    drop_stored(again)
    drop_stored(from_blocks)
    release(spark)
    return spans


def _lists(column: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Where the list of each row lies in the column's values; nowhere for a null."""
    ends = column.offsets.to_numpy()
    there = column.is_valid().to_numpy(zero_copy_only=False)
    for first, end, valid in zip(ends, ends[1:], there, strict=False):
        yield (first, end) if valid else (0, 0)


def _merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that spans cover together, in order."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    begins = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    return first[begins], end[np.append(begins[1:], len(first)) - 1]


def _runs(batch: pa.RecordBatch, sizes: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first, end) of the removed runs of each row (blocks, places, copied)."""
    blocks, places, copied = (batch.column(c) for c in ("blocks", "places", "copied"))
    firsts, ends = (f.to_numpy(zero_copy_only=False) for f in blocks.values.flatten())
    starts = places.values.to_numpy(zero_copy_only=False)
    whole = copied.is_valid().to_numpy(zero_copy_only=False)
    rows = zip(whole, sizes, _lists(blocks), _lists(places), strict=True)
    for all_of_it, size, (a, b), (c, d) in rows:
        if all_of_it:
            yield np.zeros(1, np.int64), np.array([size])
        elif b == a and d == c:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            first = np.concatenate([firsts[a:b], starts[c:d]]).astype(np.int64)
            yield _merged(first, np.concatenate([ends[a:b], starts[c:d] + length]).astype(np.int64))


def text_class(text: Column) -> Column:
    return F.xxhash64(text, F.octet_length(text))


def remove_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 200,
    carry: Sequence[str] = (),
    as_text: bool = False,
) -> DataFrame:
    """Every document's text without the bytes of strings of `length` bytes that occur again.

    Texts are UTF-8 bytes. A byte goes if it lies in a string of `length` bytes that also begins
    anywhere else, in the same document too; strings do not cross documents, and are judged on the
    input. Returns, per input row, `doc_id`, n_bytes, spans (array of first, end: the maximal
    removed runs) and kept (binary: what remains, in order; it may end within a character). With
    `as_text`, kept is a string, without characters that were cut through.

    Null counts as empty; empty and shorter texts lose nothing. Documents with equal texts of
    `length` bytes or more lose them whole, repeated rows too. Only ids, ranks and the texts that
    lose something are shuffled; other columns are not read, but those named in `carry`, which come
    along in a struct named row. Equal texts are looked at once. Ranks
    are counted in the tasks first, so a string in very many documents meets as one row per task.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *carried(carry)
    ).withColumn("cls", text_class(F.col("text")))
    raw = F.col("text").cast("binary").alias("raw")
    long_rows = rows.where(F.octet_length("text") >= length)
    mark = F.xxhash64("key")
    classes = long_rows.groupBy("cls").agg(F.min(mark).alias("mark"), F.count("cls").alias("n"))
    classes = stored(classes, "repeats-classes")
    leads = classes.select(F.col("cls").bitwiseXOR(F.col("mark")).alias("lead"))
    leads = spark.sparkContext.broadcast(collect_bitmap(leads, "lead", probes=LEAD_PROBES))
    texts = Texts(long_rows.select("cls", mark.alias("mark"), raw), leads)
    spans = repeated_spans(texts, length)
    copies = classes.where("n > 1").select("cls")
    touched = copies.unionByName(spans.select("cls"))
    bitmap = spark.sparkContext.broadcast(collect_bitmap(touched, "cls"))
    losses = spans.join(copies.withColumn("copied", F.lit(True)), "cls", "full")

    def split(wanted: bool):
        def run(batches):
            for batch in batches:
                cls = batch.column("cls").to_numpy(zero_copy_only=False).view(np.uint64)
                yield batch.filter(pa.array(in_bitmap(bitmap.value, cls) == wanted))

        return run

    schema = rows.schema
    affected = rows.mapInArrow(split(True), schema).join(losses, "cls", "left")
    also = [field for field in schema if field.name == "row"]
    kept = "string" if as_text else "binary"
    out = StructType.fromDDL(f"n_bytes long, spans array<struct<first:int,end:int>>, kept {kept}")
    out = StructType([schema["key"], *out, *also])

    def cut(batches):
        for batch in batches:
            texts = [raw.as_buffer().to_pybytes() for raw in batch.column("raw")]
            sizes = np.array([len(raw) for raw in texts], np.int64)
            kept, runs = [], list(_runs(batch, sizes, length))
            for raw, (first, end) in zip(texts, runs, strict=True):
                pieces = zip([0, *end.tolist()], [*first.tolist(), len(raw)], strict=True)
                left = b"".join([raw[a:b] for a, b in pieces])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
            column = lambda k: np.concatenate([r[k] for r in runs]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([column(0), column(1)], ["first", "end"])
            offsets = np.cumsum([0, *(len(first) for first, _ in runs)])
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                    pa.array(kept, pa.string() if as_text else pa.binary()),
                    *batch.columns[5:],
                ],
                names=names,
            )

    names, rest = out.fieldNames(), [field.name for field in also]
    lost = affected.select("key", raw, "blocks", "places", "copied", *rest).mapInArrow(cut, out)
    whole = rows.mapInArrow(split(False), schema).select(
        "key",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.expr("cast(array() as array<struct<first:int,end:int>>)").alias("spans"),
        F.col("text").cast(kept).alias("kept"),
        *rest,
    )
    return lost.unionByName(whole).withColumnRenamed("key", doc_id)
