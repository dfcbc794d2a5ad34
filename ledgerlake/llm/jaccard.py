"""Documents whose sets of word shingles are alike, by a sparse product of the incidence matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import collect_bitmap, in_bitmap
from ledgerlake.llm.components import components
from ledgerlake.llm.string_counts import repeated
from ledgerlake.llm.tables import drop_stored, few_rows_at_once, release, stored
from ledgerlake.llm.words import ODD, groups, mixed
from ledgerlake.llm.workers import lean

#: A shingle that so many sets have among their first ones is put behind the others.
COMMON = 64
#: Longs of the parity sketch that each set takes along.
SKETCH = 4
#: Longs of the parity sketch of the classes that meet all others at last.
WIDE = 16
#: How often classes that are in different components meet one other, before all meet.
TURNS = 2
#: All meet first in one of so many shingles, which joins most groups, and at last in every one.
SHARES = (8, 1)
#: Bits that are looked at to tell the rows that stand for their class.
LEAD_PROBES = 3
#: Rows that a task gathers before it hands them on.
ROWS = 200_000
#: Open classes are told apart by half of the hashes there are first; what is left, by all.
HALF, WHOLE = 1 << 63, 1 << 64


class Likeness(NamedTuple):
    """Two sets link when their intersection is at least `num` / `den` of their union."""

    words: int = 5
    num: int = 80
    den: int = 100

    def first(self, n: int) -> int:
        """How many of n shingles, in the common order, must hold one that a like set has too."""
        return n - -(-self.num * n // self.den) + 1

    def leading(self, n: Column) -> Column:
        return n - F.floor((n * self.num + (self.den - 1)) / self.den) + 1

    def overlap(self, sizes: Column) -> Column:
        """The least intersection of like sets whose sizes have this sum."""
        both = self.num + self.den
        return F.floor((sizes * self.num + (both - 1)) / both)


def _sorted_set(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])]


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The distinct hashes (uint64, ascending) of each text's runs of `width` words; of all its
    words, if it has fewer; none, if it has none. `words`: one text behind the other."""
    runs = _shingles(words, width) if len(words) >= width else words[:0]
    end = 0
    for n in counts.tolist():
        first, end = end, end + n
        if n >= width:
            yield _sorted_set(runs[first : end - width + 1])
        else:
            yield _shingles(words[first:end], n) if n else words[:0]


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    total = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        total = total * ODD + words[k : len(words) - width + 1 + k]
    return mixed(total + np.uint64(width))


def _sketch(hashes: np.ndarray, longs: int = SKETCH) -> np.ndarray:
    """A bit for each of many classes of hashes: whether the set has an odd number of them."""
    bits = np.bincount((hashes >> np.uint64(40)) & np.uint64(64 * longs - 1), minlength=64 * longs)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _spread(hashes: np.ndarray) -> np.ndarray:
    """The hashes with their halves exchanged: the smallest ones of a set have all first bits."""
    return (hashes << np.uint64(32)) | (hashes >> np.uint64(32))


def _class(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


class Texts(NamedTuple):
    """Texts (mark long, raw binary), the mark of the row that stands for each class of equal sets and
    the size of the set (cls, mark, n), and a bitmap of class XOR mark. Other rows are passed over."""

    rows: DataFrame
    classes: DataFrame
    leads: Broadcast


def _each_set(batches, width: int, leads: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(class, shingles) of the texts that stand for their class. (The bitmap may let a copy more
    through here and there; within a task each class comes once.)"""
    seen: set[int] = set()
    for part, words, counts in groups(batches, "raw"):
        marks = part.column("mark").to_numpy(zero_copy_only=False)
        sets = list(shingle_sets(words, counts, width))
        classes = np.array([_class(s) for s in sets], np.int64)
        for k in np.flatnonzero(in_bitmap(leads, (classes ^ marks).view(np.uint64), LEAD_PROBES)):
            if len(sets[k]) and int(classes[k]) not in seen:
                seen.add(int(classes[k]))
                yield int(classes[k]), sets[k]


def _flat(texts: Texts, rule: Likeness, schema: str, rows) -> DataFrame:
    """rows(class, shingles): numpy columns of `schema`, for each class."""
    names = [field.split()[0] for field in schema.split(", ")]
    leads, width = texts.leads, rule.words

    def run(batches):
        held: list[tuple] = []
        size = 0
        for cls, hashes in _each_set(batches, width, leads.value):
            held.append(rows(cls, hashes))
            size += len(held[-1][0])
            if size >= ROWS:
                yield _gathered(held, names)
                held, size = [], 0
        if size:
            yield _gathered(held, names)

    return texts.rows.mapInArrow(lean(run), schema)


def _gathered(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]
    return pa.record_batch(columns, names=names)


def _in_order(hashes: np.ndarray, common: Broadcast) -> np.ndarray:
    """Shingles that few sets have first, in an order that is the same for all sets."""
    behind = common.value.may(_spread(hashes))
    return np.concatenate([hashes[~behind], hashes[behind]])


def _postings(texts: Texts, rule: Likeness) -> DataFrame:
    """The part of the incidence matrix that can tell like sets: rank (of the shingle), shared (which
    part of the set's leading shingles is in other sets too), cls, n (size of the set), alone (how many
    of its leading shingles no other set leads with), behind and last (where in the common order its
    leading shingles end) and sketch_0, ...

    Like sets share one of their `rule.first` shingles in any common order. Shingles that many sets
    have first by hash go behind, and those that only one set has are left out; both are told by
    bitmaps of bounded size, which may put too many behind or leave too few out, at no loss.
    """
    spark, leads = texts.rows.sparkSession, texts.leads
    n = F.col("n")
    total = texts.classes.where(n > 0).agg(F.sum(rule.leading(n))).first()[0] or 0

    def counted(rows, least: int) -> Broadcast:
        def found(batches):
            return ((_spread(rows(hashes)),) for _, hashes in _each_set(batches, rule.words, leads.value))

        often = spark.sparkContext.broadcast(repeated(texts.rows, found, total, least))
        release(spark)
        return often

    common = counted(lambda hashes: hashes[: rule.first(len(hashes))], COMMON)

    def leading(hashes: np.ndarray) -> np.ndarray:
        return _in_order(hashes, common)[: rule.first(len(hashes))]

    shared = counted(leading, 2)

    def posting(cls: int, hashes: np.ndarray):
        front = leading(hashes)
        ranks = front[shared.value.may(_spread(front))]
        part = np.full(len(ranks), len(ranks) / len(front), np.float32)
        same = lambda value, kind: np.full(len(ranks), value, kind)
        sketch = _sketch(hashes) if len(ranks) else [0] * SKETCH
        sizes = same(len(hashes), np.int32)
        alone = same(len(front) - len(ranks), np.int32)
        behind = same(bool(common.value.may(_spread(front[-1:]))[0]), bool)
        last = same((front[-1:] ^ np.uint64(1 << 63)).view(np.int64)[0], np.int64)  # signed, in order
        sketches = [same(s, np.int64) for s in sketch]
        return ranks.view(np.int64), part, same(cls, np.int64), sizes, alone, behind, last, *sketches

    sketch = ", ".join(f"sketch_{k} long" for k in range(SKETCH))
    return _flat(texts, rule, f"rank long, shared float, cls long, n int, alone int, behind boolean, last long, {sketch}", posting)


def _may_link(rule: Likeness, x: str, y: str) -> Column:
    """Whether the sizes, sketches and leading shingles of two sets leave room for a link.

    What the set whose leading shingles end first has alone among these, the other one lacks: it
    would be one of its leading shingles too.
    """
    col = lambda side, name: F.col(f"{side}.{name}")
    n, m = col(x, "n"), col(y, "n")
    differ = sum(
        (F.bit_count(col(x, f"sketch_{k}").bitwiseXOR(col(y, f"sketch_{k}"))) for k in range(SKETCH)),
        F.lit(0),
    )
    end = lambda side: F.struct(col(side, "behind"), col(side, "last"))
    most = F.when(end(x) <= end(y), n - col(x, "alone")).otherwise(m - col(y, "alone"))
    return (
        (n * rule.den >= m * rule.num)
        & (m * rule.den >= n * rule.num)
        & (most >= rule.overlap(n + m))
        & (differ <= n + m - 2 * rule.overlap(n + m))
    )


def _met(
    rows: DataFrame, others: DataFrame, on: list[str], rule: Likeness, also: Column, may=_may_link
) -> DataFrame:
    """a, b, both, least: pairs of classes that share leading shingles, how many, and how many like
    sets of their sizes share at least: of two sets, what one has behind its leading shingles is all
    that can be common besides."""
    return (
        rows.alias("x")
        .join(others.alias("y"), on)
        .where(also & may(rule, "x", "y"))
        .groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
        .agg(F.count("rank").alias("both"), F.first(_least(rule)).alias("least"))
    )


def _least(rule: Likeness) -> Column:
    """How many leading shingles like sets of the sizes of x and y share at least."""
    n, m = F.col("x.n"), F.col("y.n")
    return rule.overlap(n + m) - F.greatest(n - rule.leading(n), m - rule.leading(m))


def _open_rows(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings of shingles whose classes are not all in one component, with their labels."""
    part = postings.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls")
    )
    return stored(_between(part), "jaccard-open")


def _between(rows: DataFrame) -> DataFrame:
    """The rows of shingles whose classes have several labels."""
    parts = rows.groupBy("rank").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return rows.join(parts.where("low != high").select("rank"), "rank", "left_semi")


def _star(rows: DataFrame, rule: Likeness, order: Column, also: Column, may=_may_link) -> DataFrame:
    """a, b: each class with one other, of those that are largest by `order` among the classes of a
    shingle and of about one size the one that it meets most often, if that may be enough."""
    # Sets of which one is at most the rule's share smaller are of one size class or the next.
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(rule.den / rule.num) + 0.5)
    # Ids alone move with the shingles: what tells two sets apart is the same in all rows of a set.
    sized = rows.select("rank", "cls", size.alias("size"), order.alias("order"))
    most = sized.groupBy("rank", "size").agg(F.max(F.struct("order", F.col("cls").alias("b"))).alias("most"))
    met = sized.drop("order").join(most.select("rank", "size", "most.b"), ["rank", "size"]).where("cls != b")
    met = met.groupBy(F.col("cls").alias("a"), "b").agg(F.count("rank").alias("both"))
    sets = rows.drop("rank", "shared").dropDuplicates(["cls"])
    x, y = sets.alias("x"), sets.alias("y")
    met = met.join(x, F.col("a") == F.col("x.cls")).join(y, F.col("b") == F.col("y.cls"))
    best = (
        met.where(also & may(rule, "x", "y") & (2 * F.col("both") >= _least(rule)))
        .groupBy("a")
        .agg(F.max_by("b", "both").alias("b"))
    )
    best = stored(best, "jaccard-pairs")
    release(rows.sparkSession)
    return best


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """node, label of the components that further links join."""
    own = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
    between = links.join(own("a"), "a", "left").join(own("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")
    )
    wide = components(between).select(F.col("node").alias("label"), F.col("label").alias("wide"))
    known = labels.join(wide, "label", "left").select("node", F.coalesce("wide", "label").alias("label"))
    alone = wide.join(labels, F.col("node") == wide["label"], "left_anti").select(
        F.col("label").alias("node"), F.col("wide").alias("label")
    )
    return stored(known.unionByName(alone), "jaccard-labels")


def _whole_sets(wanted: DataFrame, texts: Texts, rule: Likeness, below: int = WHOLE) -> DataFrame:
    """cls, n (size of the set) and hashes (those of the set that are less than `below`) of the wanted
    classes (cls); of others too, here and there."""
    spark = texts.rows.sparkSession
    marks = stored(texts.classes.join(wanted, "cls").select("mark"), "jaccard-wanted")
    bitmap = spark.sparkContext.broadcast(collect_bitmap(marks, "mark"))
    drop_stored(marks)
    leads, width = texts.leads, rule.words

    def gathered(held):
        classes, sizes, parts = zip(*held, strict=True)
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))
        columns = [pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), lists]
        return pa.record_batch(columns, names=["cls", "n", "hashes"])

    def run(batches):
        def chosen():
            for batch in batches:
                mark = batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64)
                yield batch.filter(pa.array(in_bitmap(bitmap.value, mark)))

        held, size = [], 0
        for cls, hashes in _each_set(chosen(), width, leads.value):
            part = hashes if below == WHOLE else hashes[: np.searchsorted(hashes, np.uint64(below))]
            held.append((cls, len(hashes), part))
            size += len(part)
            if size >= ROWS:
                yield gathered(held)
                held, size = [], 0
        if held:
            yield gathered(held)

    return stored(texts.rows.mapInArrow(lean(run), "cls long, n long, hashes array<long>"), "jaccard-sets")


def _told(wanted: DataFrame, texts: Texts, rule: Likeness, below: int) -> DataFrame:
    """cls, own (how many shingles less than `below` no other wanted class has) and wide_0, ... (the
    parity sketch of the others there) of the wanted classes (cls) that have no more of their own than
    a like set leaves them.

    Both sets of a pair are wanted, so what they share is never counted as one's own; the bits of
    repeated shingles may count too few, at no loss.
    """
    spark = texts.rows.sparkSession
    sets = _whole_sets(wanted, texts, rule, below)

    def shingles(batches):
        for batch in batches:
            yield (_spread(batch.column("hashes").flatten().to_numpy().view(np.uint64)),)

    total = sets.agg(F.sum(F.size("hashes"))).first()[0] or 0
    others = spark.sparkContext.broadcast(repeated(sets, shingles, total))

    def run(batches):
        for batch in batches:
            found = []
            classes, sizes = batch.column("cls").to_pylist(), batch.column("n").to_pylist()
            for cls, n, row in zip(classes, sizes, batch.column("hashes"), strict=True):
                hashes = row.values.to_numpy().view(np.uint64)
                rest = hashes[others.value.may(_spread(hashes))]
                if len(hashes) - len(rest) < rule.first(n):
                    found.append([cls, len(hashes) - len(rest), *_sketch(rest, WIDE).tolist()])
            columns = zip(*found, strict=True) if found else [()] * (2 + WIDE)
            names = ["cls", "own", *[f"wide_{k}" for k in range(WIDE)]]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    wide = ", ".join(f"wide_{k} long" for k in range(WIDE))
    told = stored(sets.mapInArrow(lean(run), f"cls long, own long, {wide}").dropDuplicates(["cls"]), "jaccard-told")
    drop_stored(sets)
    release(spark)
    return told


def _told_apart(open_rows: DataFrame, texts: Texts, rule: Likeness) -> DataFrame:
    """The open rows (rank, cls, n, label), with own (how many shingles of the whole set no other open
    class has) and wide_0, ... (the parity sketch of the others). Classes that have more of their own
    than any like set leaves them are left out.

    Half of the hashes tell most of them, so that few whole sets are written.
    """
    rows = open_rows
    for below in (HALF, WHOLE):
        told = _told(rows.select("cls").distinct(), texts, rule, below)
        before, rows = rows, stored(_between(rows.select("rank", "cls", "n", "label").join(told, "cls")), "jaccard-open")
        drop_stored(told)
        if before is not open_rows:
            drop_stored(before)
    release(texts.rows.sparkSession)
    return rows


def _told_may_link(rule: Likeness, x: str, y: str) -> Column:
    """Whether the sizes of two sets, what each has of its own and the sketches of the rest leave room
    for a link."""
    col = lambda side, name: F.col(f"{side}.{name}")
    n, m = col(x, "n"), col(y, "n")
    differ = sum(
        (F.bit_count(col(x, f"wide_{k}").bitwiseXOR(col(y, f"wide_{k}"))) for k in range(WIDE)),
        col(x, "own") + col(y, "own"),
    )
    least = rule.overlap(n + m)
    return (
        (n * rule.den >= m * rule.num)
        & (m * rule.den >= n * rule.num)
        & (F.least(n - col(x, "own"), m - col(y, "own")) >= least)
        & (differ <= n + m - 2 * least)
    )


def _linked(pairs: DataFrame, texts: Texts, rule: Likeness) -> DataFrame:
    """The pairs (a, b: classes) whose sets are like, by their whole overlap."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = _whole_sets(wanted, texts, rule)
    left = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("right"))
    both = F.size(F.array_intersect("left", "right")).cast("long")
    union = F.size("left") + F.size("right") - F.col("both")
    found = (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("both", both)
        .where(rule.den * F.col("both") >= rule.num * union)
        .select("a", "b")
    )
    found = stored(found, "jaccard-links")
    drop_stored(sets)
    release(texts.rows.sparkSession)
    return found


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    rule: Likeness = Likeness(),  # noqa: B008
) -> DataFrame:
    """`doc_id`, n_shingles (size of the set) and component_id of every row.

    A document's set: its distinct runs of `rule.words` words (all its words as one, if fewer).
    Documents link when their sets are like (`Likeness`), and component_id is the smallest id that
    links reach, its own included. Null and empty texts, and texts without words, have no set and
    link with nothing; a null id is no component's smallest unless there is no other. Repeated rows
    and equal texts share a component. Other columns are not read.

    Equal sets become one class. The product of the incidence matrix with its transpose is taken
    over the rows of a shingle. First each class meets one other of those of the shingle's classes
    that are about as large: the one of which most is shared, as what others were copied from; and
    the one that it meets most often is compared with it. Classes of shingles that are not yet in one
    component are then told apart by what each has of its own among them and by a wider sketch of the
    rest. Those that may still have a like one meet others in turn, then all in a share
    of the shingles, and at last, of each shingle, all that are in different components meet. So a
    group of near copies makes
    about as many pairs as it has members, while no link between components is lost: pairs are left
    out only by bounds that like sets cannot miss, and what remains is decided by the overlap of the
    whole sets.
    """
    spark = docs.sparkSession
    few_rows_at_once(spark)
    rows = docs.select(
        F.col(doc_id).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw"),
    )
    kind = rows.schema["key"].dataType.simpleString()

    def sizes(batches):
        for part, words, counts in groups(batches, "raw"):
            sets = list(shingle_sets(words, counts, rule.words))
            classes = pa.array([_class(s) for s in sets], pa.int64())
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.record_batch([part.column("key"), classes, n], names=["key", "cls", "n_shingles"])

    members = rows.mapInArrow(lean(sizes), f"key {kind}, cls long, n_shingles long")
    members = stored(members, "jaccard-sizes")
    mark = F.xxhash64("key")
    classes = members.groupBy("cls").agg(F.min(mark).alias("mark"), F.first("n_shingles").alias("n"))
    classes = stored(classes, "jaccard-classes")
    leads = classes.select(F.col("cls").bitwiseXOR(F.col("mark")).alias("lead"))
    leads = spark.sparkContext.broadcast(collect_bitmap(leads, "lead", probes=LEAD_PROBES))
    raw_rows = rows.where(F.length("raw") > 0).select(mark.alias("mark"), "raw")
    texts = Texts(raw_rows, classes, leads)
    postings = stored(_postings(texts, rule), "jaccard-postings")

    pairs = _star(postings, rule, F.col("shared"), F.col("x.cls") != F.col("y.cls"))
    labels = stored(components(_linked(pairs, texts, rule)), "jaccard-labels")
    apart = F.col("x.label") != F.col("y.label")
    open_rows = _open_rows(postings, labels)
    drop_stored(postings)
    release(spark)
    before, open_rows = open_rows, _told_apart(open_rows, texts, rule)
    drop_stored(before)
    for turn in range(TURNS):
        pairs = _star(open_rows, rule, F.xxhash64("cls", F.lit(turn)), apart, _told_may_link)
        labels = _joined(labels, _linked(pairs, texts, rule))
        before, open_rows = open_rows, _open_rows(open_rows.drop("label"), labels)
        drop_stored(before)
        release(spark)
    once = (F.col("x.cls") < F.col("y.cls")) & apart
    for share in SHARES:
        some = open_rows.where(F.pmod(F.xxhash64("rank"), F.lit(share)) == 0)
        more = _met(some, some, ["rank"], rule, once, _told_may_link)
        if share == 1:
            more = more.where(F.col("both") >= F.col("least"))
        more = stored(more.select("a", "b"), "jaccard-more")
        release(spark)
        labels = _joined(labels, _linked(more, texts, rule))
        if share > 1:
            before, open_rows = open_rows, _open_rows(open_rows.drop("label"), labels)
            drop_stored(before)
            release(spark)
    drop_stored(open_rows)
    labels = labels.select(F.col("node").alias("cls"), F.col("label").alias("part"))
    placed = members.join(labels, "cls", "left").withColumn("part", F.coalesce("part", "cls"))
    least = placed.groupBy("part").agg(F.min("key").alias("least"))
    return placed.join(least, "part").select(
        F.col("key").alias(doc_id),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"),
    )
