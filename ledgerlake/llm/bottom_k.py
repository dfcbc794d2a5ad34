"""Near copies among documents, by the smallest hashes of their shingles (bottom-k sketches).

Every set is hashed by one function. A short sketch of all sets tells which of them share enough
values with others to be like one at all. Of these a longer sketch is taken, its values are listed,
the rare ones first, and sets that meet in a list are compared: by what their places, sizes and
parities leave possible, by the sketch of their union, and at last by the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import collect_bitmap, in_bitmap
from ledgerlake.llm.components import components
from ledgerlake.llm.jaccard import shingle_sets
from ledgerlake.llm.tables import drop_stored, release, stored
from ledgerlake.llm.words import groups
from ledgerlake.llm.workers import lean
from ledgerlake.operators.lookups import left_lookup


class Sketch(NamedTuple):
    """The k smallest hashes of a set, and how many of them two like sets share at least.

    Of the k smallest hashes of the union each is in both sets with the chance that the likeness
    tells. For sets at 0.85, fewer than 26 of 64, or 160 of 256, have a chance below 10^-14. Where
    sizes alone tell more, and for sets of up to k shingles, the bound is certain.
    """

    k: int
    least: int


class Rule(NamedTuple):
    """Two sets link when their intersection is at least `num` / `den` of their union."""

    words: int = 3
    num: int = 85
    den: int = 100
    short: Sketch = Sketch(64, 26)
    long: Sketch = Sketch(256, 160)

    def shared(self, n: np.ndarray, sketch: Sketch) -> np.ndarray:
        """How many values of its sketch a set of n shingles shares with any like set, at least."""
        sure = np.minimum(n, sketch.k) - n * (self.den - self.num) // self.num
        return np.where(n > sketch.k, np.maximum(sure, sketch.least), sure)

    def apart(self, sizes: Column) -> Column:
        """How many shingles are in one of two like sets only, at most, by the sum of their sizes."""
        return F.floor(sizes * (self.den - self.num) / (self.den + self.num))


#: A value is listed behind those that fewer sets have; these are the steps. 2 is the first that meets.
STEPS = (2, 8, 64, 512)
#: Bits of the parity of a set's hashes, in longs; wider for the classes that may meet all others at last.
PARITY, WIDE = 8, 16
#: How often classes that are in different components meet one other, before all meet.
TURNS = 1
#: Before, all meet in one of so many lists and then in four times as many, which joins most groups; what
#: a step joins does not meet in the next.
SHARE = 16
#: Rows of a list that meet in one task.
LIST = 512
#: Rows that a task gathers before it hands them on.
ROWS = 20_000


def _parity(hashes: np.ndarray, longs: int = PARITY) -> np.ndarray:
    """A bit for each of many classes of hashes: whether the set has an odd number of them."""
    classes = (hashes >> np.uint64(40)) & np.uint64(64 * longs - 1)
    odd = np.bincount(classes.astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of hashes as lists of longs."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    values = column.values.to_numpy().view(np.uint64)
    ends = column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _sketched(rows: DataFrame, rule: Rule) -> DataFrame:
    """key, cls (hash of the set), n and sketch (of the short kind) of every row."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for part, words, counts in groups(batches, "raw"):
            sets = list(shingle_sets(words, counts, rule.words))
            classes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            yield pa.record_batch(
                [
                    part.column("key"),
                    pa.array(classes, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([s[: rule.short.k] for s in sets]),
                ],
                names=["key", "cls", "n", "sketch"],
            )

    return rows.mapInArrow(lean(run), f"key {kind}, cls long, n long, sketch array<long>")


def _value_counts(values: DataFrame) -> DataFrame:
    """The values (value long) that occur twice or more, and how often."""
    return values.groupBy("value").agg(F.count("*").alias("sets")).where("sets > 1")


def _candidates(classes: DataFrame, rule: Rule) -> DataFrame:
    """cls and mark of the classes that share enough of their sketch with others."""
    spark = classes.sparkSession
    values = stored(_value_counts(classes.select(F.explode("sketch").alias("value"))), "bottom-k-values")
    bitmap = spark.sparkContext.broadcast(collect_bitmap(values, "value", probes=2))
    drop_stored(values)

    def run(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            sketches = batch.column("sketch")
            found = in_bitmap(bitmap.value, sketches.flatten().to_numpy().view(np.uint64), probes=2)
            before = np.concatenate([[0], np.cumsum(found)])
            ends = sketches.offsets.to_numpy() - sketches.offsets[0].as_py()
            shared = before[ends[1:]] - before[ends[:-1]]
            enough = pa.array((n > 0) & (shared >= np.maximum(rule.shared(n, rule.short), 1)))
            yield batch.select(["cls", "mark"]).filter(enough)

    found = stored(classes.mapInArrow(lean(run), "cls long, mark long"), "bottom-k-candidates")
    bitmap.destroy()
    return found


def _whole_sets(rows: DataFrame, candidates: DataFrame, rule: Rule) -> DataFrame:
    """cls and hashes (all of its set) of the candidates."""
    spark = rows.sparkSession
    bitmap = spark.sparkContext.broadcast(collect_bitmap(candidates, "mark", probes=2))

    def run(batches):
        def wanted():
            for batch in batches:
                marks = batch.column("mark").to_numpy().view(np.uint64)
                yield batch.filter(pa.array(in_bitmap(bitmap.value, marks, probes=2)))

        for part, words, counts in groups(wanted(), "raw"):
            sets = list(shingle_sets(words, counts, rule.words))
            classes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            yield pa.record_batch(
                [pa.array(classes, pa.int64()), part.column("mark"), _lists(sets)],
                names=["cls", "mark", "hashes"],
            )

    found = rows.select("mark", "raw").mapInArrow(lean(run), "cls long, mark long, hashes array<long>")
    # The bitmap may let other rows through, and equal ids of equal texts come more than once.
    chosen = found.join(candidates, ["cls", "mark"], "left_semi").groupBy("cls")
    sets = stored(chosen.agg(F.first("hashes").alias("hashes")), "bottom-k-sets")
    bitmap.destroy()
    return sets


def _postings(sets: DataFrame, rule: Rule) -> DataFrame:
    """The inverted lists: value, cls, n, place, alone, own (0: not told yet) and the parities.

    A sketch's values are put in an order that is the same for all sets, rare ones first. A like set
    shares `rule.shared` of them, so at least one of the first k - shared + 1; only these are listed.
    Values that no other set has are left out of the lists, but keep their places.
    """
    spark, k = sets.sparkSession, rule.long.k
    values = sets.select(F.explode(F.slice("hashes", 1, k)).alias("value"))
    counts = stored(_value_counts(values), "bottom-k-values")
    steps = [
        spark.sparkContext.broadcast(collect_bitmap(counts.where(F.col("sets") >= step), "value", probes=2))
        for step in STEPS
    ]
    drop_stored(counts)
    names = ["value", "cls", "n", "place", "alone", *[f"odd_{i}" for i in range(PARITY)]]
    kinds = [np.int64, np.int64, np.int32, np.int32, np.int32, *[np.int64] * PARITY]

    def run(batches):
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for cls, hashes in zip(batch.column("cls").to_pylist(), _arrays(batch.column("hashes")), strict=True):
                n = len(hashes)
                sketch = hashes[:k]
                step = sum(in_bitmap(b.value, sketch, probes=2).astype(np.int64) for b in steps)
                order = np.argsort(step, kind="stable")
                alone = int((step == 0).sum())
                front = len(sketch) - int(rule.shared(np.array(n), rule.long)) + 1
                listed = sketch[order[alone:front]]
                if not len(listed):
                    continue
                same = [cls, n, alone, *_parity(hashes).tolist()]
                columns = [np.full(len(listed), v, np.int64) for v in same]
                places = np.arange(alone, front)
                held.append([listed.view(np.int64), *columns[:2], places, *columns[2:]])
                size += len(listed)
                if size >= ROWS:
                    yield _gathered(held, names, kinds)
                    held, size = [], 0
        if held:
            yield _gathered(held, names, kinds)

    types = {np.int64: "long", np.int32: "int"}
    schema = ", ".join(f"{c} {types[t]}" for c, t in zip(names, kinds, strict=True))
    found = stored(sets.mapInArrow(lean(run), schema).withColumn("own", F.lit(0)), "bottom-k-lists")
    for b in steps:
        b.destroy()
    return found


def _gathered(held: list[list[np.ndarray]], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.record_batch(
        [pa.array(np.concatenate(c).astype(t, copy=False)) for c, t in zip(columns, kinds, strict=True)],
        names=names,
    )


def _may_link(rule: Rule, longs: int) -> Column:
    """Whether what x and y are told to be (parities of so many longs) leaves room for a link."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    n, m, k = x("n"), y("n"), rule.long.k
    sizes = n.cast("long") + m
    apart = rule.apart(sizes)
    odd = sum(
        (F.bit_count(x(f"odd_{i}").bitwiseXOR(y(f"odd_{i}"))) for i in range(longs)), x("own") + y("own")
    )
    # Shared values: those before this one, this one, and those behind it.
    kept = lambda size: F.least(size, F.lit(k))
    before = F.least(x("place") - x("alone"), y("place") - y("alone"))
    behind = F.least(kept(n) - x("place"), kept(m) - y("place"))
    whole = F.ceil(sizes * rule.num / (rule.num + rule.den))
    least = F.when(F.greatest(n, m) <= k, whole).otherwise(F.greatest(F.lit(rule.long.least), k - apart))
    return (
        (n * rule.den >= m * rule.num)
        & (m * rule.den >= n * rule.num)
        & (before + behind >= least)
        & (odd <= apart)
    )


def _in_blocks(lists: DataFrame) -> DataFrame:
    """The rows of lists that have several labels, with block and blocks: long lists come in parts."""
    sizes = lists.groupBy("value").agg(
        F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    sizes = sizes.where("low != high").select("value", F.ceil(F.col("rows") / LIST).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    return lists.join(sizes, "value").withColumn("block", block)


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of lists whose classes are not all in one component, with their labels."""
    named = lists.drop("label").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("label", F.coalesce("label", "cls"))
    parts = named.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return stored(named.join(parts.where("low != high"), "value", "left_semi"), "bottom-k-lists")


def _told_apart(lists: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The lists with own (how many hashes of the whole set no other class of the lists has) and the
    (wider) parities of the others. Classes that have more of their own than any like set leaves them are
    left out.

    Both sets of a pair are in the lists, so what they share is never counted as one's own; the
    bitmap may count too few, at no loss.
    """
    spark = lists.sparkSession
    odd = [f"odd_{i}" for i in range(WIDE)]
    chosen = stored(sets.join(lists.select("cls").distinct(), "cls", "left_semi"), "bottom-k-open")
    counts = stored(_value_counts(chosen.select(F.explode("hashes").alias("value"))), "bottom-k-values")
    others = spark.sparkContext.broadcast(collect_bitmap(counts, "value", probes=2))
    drop_stored(counts)

    def run(batches):
        for batch in batches:
            found = []
            for cls, hashes in zip(batch.column("cls").to_pylist(), _arrays(batch.column("hashes")), strict=True):
                rest = hashes[in_bitmap(others.value, hashes, probes=2)]
                own = len(hashes) - len(rest)
                if own * rule.den <= len(hashes) * (rule.den - rule.num):
                    found.append([cls, own, *_parity(rest, WIDE).tolist()])
            columns = zip(*found, strict=True) if found else [()] * (2 + WIDE)
            names = ["cls", "own", *odd]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    told = chosen.select("cls", "hashes").mapInArrow(lean(run), ", ".join(f"{c} long" for c in ["cls", "own", *odd]))
    found = stored(lists.drop("own", *odd).join(told, "cls"), "bottom-k-lists")
    others.destroy()
    drop_stored(chosen)
    return found


def _with_hub(lists: DataFrame, rule: Rule, order: Column, longs: int) -> DataFrame:
    """a, b: each class with one of its block of a list, the first by `order`, which is the same for
    all lists where it can be."""
    rows = _in_blocks(lists)
    hub = F.struct(order.alias("order"), "label", *[c for c in lists.columns if c not in ("value", "label")])
    hubs = rows.groupBy("value", "block").agg(F.min(hub).alias("hub")).select("value", "block", "hub.*")
    hubs = hubs.drop("order")
    met = rows.alias("x").join(hubs.alias("y"), ["value", "block"])
    apart = F.col("x.label") != F.col("y.label")
    return met.where(apart & _may_link(rule, longs)).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()


def _all_open(lists: DataFrame, rule: Rule) -> DataFrame:
    """a, b: all pairs of a list that are not in one component yet and may link."""
    return _in_share(lists, rule, 1)


def _in_share(lists: DataFrame, rule: Rule, share: int) -> DataFrame:
    """a, b: of one in `share` lists all pairs that are not in one component yet and may link.

    The blocks of a list meet two by two, so that no task has more than two of them.
    """
    rows = _in_blocks(lists.where(F.pmod(F.xxhash64("value"), F.lit(share)) == 0))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    meet = F.transform(every, lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    dealt = rows.select("*", F.inline(meet))
    x, y = dealt.alias("x"), dealt.alias("y")
    once = F.when(F.col("x.i") == F.col("x.j"), F.col("x.cls") < F.col("y.cls")).otherwise(
        F.col("x.block") < F.col("y.block")
    )
    met = x.join(y, ["value", "i", "j"]).where(once & (F.col("x.label") != F.col("y.label")) & _may_link(rule, WIDE))
    ends = [F.col("x.cls"), F.col("y.cls")]
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sets are like: told by the sketch of their union first, then by the whole sets."""
    own = lambda side: sets.select(F.col("cls").alias(side), F.col("hashes").alias(f"{side}_set"))
    both = stored(pairs, "bottom-k-pairs").join(own("a"), "a").join(own("b"), "b")
    k, least = rule.long

    def like(x: np.ndarray, y: np.ndarray) -> bool:
        common = np.intersect1d(x, y, assume_unique=True)
        if len(common) * rule.den < (len(x) + len(y) - len(common)) * rule.num:
            return False
        return True

    def may(x: np.ndarray, y: np.ndarray) -> bool:
        if len(x) <= k and len(y) <= k:
            return True  # the sketches are the sets
        union, times = np.unique(np.concatenate([x[:k], y[:k]]), return_counts=True)
        return int((times[np.argsort(union, kind="stable")[:k]] == 2).sum()) >= least

    def run(batches):
        for batch in batches:
            sides = zip(_arrays(batch.column("a_set")), _arrays(batch.column("b_set")), strict=True)
            found = [may(x, y) and like(x, y) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    return stored(both.mapInArrow(lean(run), "a long, b long"), "bottom-k-links")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Rule = Rule(),  # noqa: B008
) -> DataFrame:
    """`doc_id`, n_shingles (size of the set), component_id and kept of every row.

    A document's set: its distinct runs of `rule.words` words (all its words as one, if fewer).
    Documents link when their sets are like (`Rule`); component_id is the smallest id that links
    reach, its own included, and kept tells the rows that have that id. Null and empty texts, and
    texts without words, have no set and link with nothing. A null id is no component's smallest
    unless there is no other. Repeated rows and equal texts share a component. Other columns are not
    read.

    Equal sets are one class. First the classes of a list meet one of them, which joins most of a
    group of near copies; those that are in different components, told apart by what each has of its
    own among them, then meet another one in turn, all others in growing shares of the lists, and at
    last in every list, so that near copies of one group rarely meet twice. Links are confirmed by the whole
    sets; a link can be missed only by the sketches' bounds (`Sketch`).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw"),
    )
    marked = rows.select(F.xxhash64("key").alias("mark"), "raw")
    sketched = stored(_sketched(rows, rule), "bottom-k-sketches")
    members = sketched.select("key", "cls", "n")
    classes = sketched.where("n > 0").groupBy("cls").agg(
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
        F.min(F.xxhash64("key")).alias("mark"),
    )
    classes = stored(classes, "bottom-k-classes")
    candidates = _candidates(classes, rule)
    drop_stored(classes)
    sets = _whole_sets(marked, candidates, rule)
    lists = _postings(sets, rule)

    links = _linked(_with_hub(lists.withColumn("label", F.col("cls")), rule, F.col("label"), PARITY), sets, rule)
    labels = stored(components(links), "bottom-k-labels")
    named = _open_lists(lists, labels)
    drop_stored(lists)
    told = _told_apart(named, sets, rule)
    drop_stored(named)
    release(spark)
    for turn in range(TURNS):
        order = F.xxhash64("cls", F.lit(turn))
        links = links.unionByName(_linked(_with_hub(told, rule, order, WIDE), sets, rule))
        labels = stored(components(links), "bottom-k-labels")
        before, told = told, _open_lists(told, labels)
        drop_stored(before)
        release(spark)
    for share in (SHARE, max(1, SHARE // 4)):
        links = links.unionByName(_linked(_in_share(told, rule, share), sets, rule))
        labels = stored(components(links), "bottom-k-labels")
        before, told = told, _open_lists(told, labels)
        drop_stored(before)
        release(spark)
    more = _linked(_all_open(told, rule), sets, rule)
    labels = stored(components(links.unionByName(more)), "bottom-k-labels")
    drop_stored(told)
    drop_stored(sets)

    # The smallest id of each class, then of each component; only groups are looked up.
    least = members.where("n > 0").groupBy("cls").agg(F.min("key").alias("least"), F.count("*").alias("rows"))
    placed = least.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    placed = placed.where("label is not null or rows > 1").withColumn("part", F.coalesce("label", "cls"))
    placed = stored(placed.select("cls", "part", "least"), "bottom-k-groups")
    parts = placed.groupBy("part").agg(F.min("least").alias("component"))
    named = stored(placed.join(parts, "part").select(F.col("cls").alias("group"), "component"), "bottom-k-names")
    found = left_lookup(members, named, F.col("cls"), "group")
    component = F.when(F.col("n") > 0, F.coalesce("component", "key")).otherwise(F.col("key"))
    return found.select(
        F.col("key").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id")))
