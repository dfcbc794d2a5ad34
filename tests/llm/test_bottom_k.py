import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bottom_k, queries
from ledgerlake.llm.tables import table

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TINY = bottom_k.Rule(short=bottom_k.Sketch(24, 6), long=bottom_k.Sketch(48, 24))


def plain(docs):
    """(doc_id, n_shingles, component_id, kept), by comparing all pairs."""
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
        width = min(3, len(words))
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set())
    root = list(range(len(docs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (key, _) in enumerate(docs):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    for k, (key, _) in enumerate(docs):
        part = least.get(find(k)) if sets[k] else key
        yield key, len(sets[k]), part, key == part


def drifting(seed, families=14):
    """Chains of texts that each differ a little from the one before, shared passages, copies."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") + str(rng.randrange(40))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(families):
        words = [word() for _ in range(rng.randrange(1, 160))]
        if rng.random() < 0.6:
            words = words[:15] + passage
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = word()
            if rng.random() < 0.3:
                words.append(word())
    return list(enumerate(texts + texts[:3] + ["", " ", None, "a", "A", "a b", "a  b", "a b c d"]))


def query(spark, df, **options):
    found = bottom_k.near_duplicates(df, **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    docs = drifting(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert query(spark, df) == sorted(plain(docs), key=repr)


def test_sketches_shorter_than_the_sets(spark, monkeypatch):
    """Long lists in blocks, sketches that leave most of a set out."""
    monkeypatch.setattr(bottom_k, "LIST", 3)
    docs = drifting(5, families=20)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert query(spark, df, rule=TINY) == sorted(plain(docs), key=repr)


def test_a_group_of_near_copies_that_do_not_all_link(spark):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        docs.append((1000 - k, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = sorted(plain(docs), key=repr)
    assert 2 < len({r[2] for r in want}) < 150
    assert query(spark, df) == want


def test_query_at_given_rows(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = plain([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()])
    got = queries.op12_bottom_k(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    clash = odd_docs.selectExpr("*", *[f"'x' AS {c}" for c in ("key", "cls", "n", "mark", "value", "component_id", "kept")])
    assert query(spark, clash) == sorted(plain(rows), key=repr)
    assert query(spark, no_docs) == []


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(None, text), (None, text), (5, text), (5, text), (5, "quite another text"), (3, text + " end"), (None, "alone here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert query(spark, df) == sorted(plain(rows), key=repr)


def test_bounds_hold_for_like_sets():
    """The least shared values, for sets of all sizes at the likeness of the rule or above."""
    rng = np.random.default_rng(3)
    rule = bottom_k.Rule()
    for _ in range(400):
        n = int(rng.integers(1, 900))
        extra = int(rng.integers(0, n * 15 // 85 + 1))
        union = np.unique(rng.integers(0, 1 << 63, n + extra, dtype=np.uint64))
        a = union[np.sort(rng.permutation(len(union))[: len(union) - extra // 2])]
        rest = np.setdiff1d(union, a)
        b = np.union1d(rest, a[np.sort(rng.permutation(len(a))[: len(a) - (extra - extra // 2)])])
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * len(union):
            continue
        for sketch in (rule.short, rule.long):
            shared = len(np.intersect1d(a[: sketch.k], b[: sketch.k]))
            for s in (a, b):
                assert shared >= rule.shared(np.array(len(s)), sketch)


def test_copies_are_one_class_and_make_no_pairs(spark):
    """A third of all rows with one text: as many listed rows as without them."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    text = docs.where("length(text) > 500").first().text
    copies = spark.range(10_000, 10_100).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    found = bottom_k.near_duplicates(docs.unionByName(copies)).where("doc_id >= 10000")
    assert found.select("component_id").distinct().count() == 1
    assert found.where("kept").count() == 0


def test_sets_with_enough_of_their_own_do_not_meet(spark, monkeypatch):
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(f"{w}x{k}" if i % 33 == 5 else w for i, w in enumerate(words))) for k in range(30)]
    all_open, met = bottom_k._all_open, []

    def counted(lists, rule):
        pairs = all_open(lists, rule)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(bottom_k, "_all_open", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in bottom_k.near_duplicates(df).collect()]
    assert sorted(got) == sorted(plain(docs))
    assert met == [0]


def test_what_met_in_a_share_of_the_lists_does_not_meet_at_last(spark, monkeypatch):
    monkeypatch.setattr(bottom_k, "TURNS", 0)
    monkeypatch.setattr(bottom_k, "SHARE", 1, raising=False)
    linked, links = bottom_k._linked, []

    def counted(*args):
        links.append(linked(*args))
        return links[-1]

    monkeypatch.setattr(bottom_k, "_linked", counted)
    words = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join([f"x{i}" for i in range(3 * k)] + words[3 * k :])) for k in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, bottom_k.near_duplicates(df).collect())) == sorted(plain(docs))
    assert links[-1].count() == 0


def test_all_meet_in_growing_shares_of_the_lists(spark, monkeypatch):
    in_share, shares = bottom_k._in_share, []

    def counted(lists, rule, share):
        shares.append(share)
        return in_share(lists, rule, share)

    monkeypatch.setattr(bottom_k, "_in_share", counted)
    words = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join([f"x{i}" for i in range(3 * k)] + words[3 * k :])) for k in range(24)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, bottom_k.near_duplicates(df).collect())) == sorted(plain(docs))
    assert shares == [bottom_k.SHARE, bottom_k.SHARE // 4, 1]


def test_wider_parities_tell_long_sets_apart():
    rng = np.random.default_rng(3)
    x, y = (np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) << np.uint64(1)) for _ in "xy")
    near = np.concatenate([x[:890], y[890:]])  # 220 of both in one only; 162 are the most that like sets have
    differ = lambda longs: sum(
        int(a ^ b).bit_count() if a ^ b >= 0 else (int(a ^ b) + (1 << 64)).bit_count()
        for a, b in zip(bottom_k._parity(x, longs), bottom_k._parity(near, longs), strict=True)
    )
    assert differ(bottom_k.PARITY) <= 162 < differ(bottom_k.WIDE)
