import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import merkle, queries
from ledgerlake.llm.tables import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    return H(*map(framed, [row["doc_id"], row["source"], row["lang"], n, row["text"]]))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([H(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return out


def climbed(found, at):
    """(sibling or None, whether it stands left) of each level."""
    for level in found[:-1]:
        yield (level[at ^ 1] if at ^ 1 < len(level) else None), at % 2 == 1
        at //= 2


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of every row, the changed leaf where 7 divides the CRC."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in langs:
        order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))
        groups[lang].sort(key=order)
        trees[lang] = levels([leaf_of(r) for r in groups[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, row in enumerate(groups[lang]):
            path = [*climbed(trees[lang], at), *climbed(top, k)]
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf_of(row, more=int(tampered))
            for beside, is_left in path:
                node = H(beside or "", node) if is_left else H(node, beside or "")
            proof = H(*[b for b, _ in path if b])
            out.append((row["doc_id"], leaf_of(row), trees[lang][-1][0], top[-1][0], proof, node))
    return out


def query(spark, rows, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: rows)
    return [tuple(r) for r in queries.op13_merkle(spark, "").collect()]


def by_text(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("height", [2, 10])
def test_query_equals_plain_hashing(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "LEVELS", height)
    docs = table(spark, SF, "documents")
    want = plain([r.asDict() for r in docs.collect()])
    got = query(spark, docs, monkeypatch)
    assert by_text(r[:6] for r in got) == by_text(want)
    assert all(r[6] == (r[5] == r[3]) for r in got)
    assert {r[6] for r in got} == {True, False}


def test_all_sizes_of_a_run(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rng = random.Random(5)
    rows = [
        (rng.randrange(10_000), "x" * rng.randrange(3), f"l{size}", None, size)
        for size in [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31]
        for _ in range(size)
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain([r.asDict() for r in docs.collect()])
    assert by_text(r[:6] for r in query(spark, docs, monkeypatch)) == by_text(want)


def test_odd_rows(spark, monkeypatch):
    rows = [
        (None, None, None, None, None),
        (None, "", None, "", 0),
        (3, "a" * 1_000_000, "", "s", 1),
        (3, "tie", "en", "s", 1),
        (3, "tie", "en", "s", 1),
        (3, "other", "en", "s", 1),
        (4, "é漢\n", "éé", "s", None),
        (-5, "z", "zz", "s", 9),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain([r.asDict() for r in docs.collect()])
    clash = docs.selectExpr("*", *[f"'x' AS {c}" for c in ("slot", "n", "node", "path", "grp", "key", "leaf", "_at")])
    assert by_text(r[:6] for r in query(spark, clash, monkeypatch)) == by_text(want)


def test_one_hot_id(spark):
    """One id, and one text, in most rows: still numbered over many tasks."""
    docs = table(spark, SF, "documents").withColumn("doc_id", F.lit(1)).withColumn("lang", F.lit("en"))
    found = merkle.manifest(docs)
    leaves = [r.leaf for r in found.collect()]
    assert found.select("root").distinct().count() == 1
    assert levels(sorted(leaves))[-1][0] == found.first().subroot == found.first().root


def test_empty_table(spark, monkeypatch):
    docs = table(spark, SF, "documents").where("false")
    assert query(spark, docs, monkeypatch) == []
