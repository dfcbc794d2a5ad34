import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries, winnowing
from tests.llm.conftest import SF


def plain(hashes, window):
    """Winnowing of a list of hashes, as a set of (place, hash)."""
    windows = [range(k, min(k + window, len(hashes))) for k in range(max(1, len(hashes) - window + 1))]
    return {min(((hashes[i], -i) for i in w))[::-1] for w in windows if hashes}


def test_smallest_hash_of_each_window_rightmost_first(spark):
    texts = ["a b c d e f g h i j k l m n o p", "a a a a a a a a a", "x y", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in winnowing.fingerprints(df, window=4).collect():
        words = texts[row.doc_id].split()
        hashed = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
        n = max(1, len(hashed) - 2)
        rows = [tuple(hashed[k : k + 3]) + (None,) * (3 - len(hashed[k : k + 3])) for k in range(n)]
        columns = F.xxhash64("a", "b", "c").bitwiseAND(F.lit(winnowing._HASHES))
        got = spark.createDataFrame(rows, "a long, b long, c long").select(F.shiftright(columns, winnowing.PLACE_BITS)).collect()
        want = {(-i, h) for i, h in plain([g[0] for g in got], 4)}
        assert {(p["place"], p["hash"]) for p in row.fingerprint} == want


def test_runs_of_equal_tokens_share_a_fingerprint(spark):
    run = " ".join(f"w{k}" for k in range(winnowing.GRAM + winnowing.WINDOW - 1))
    rows = [(1, f"some other words {run} and an end"), (2, f"different {run}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = ({p["hash"] for p in r.fingerprint} for r in winnowing.fingerprints(df).collect())
    assert a & b


@pytest.mark.parametrize("before", ["", "一", "一二三四五", "x" * 31, "ein Satz "])
def test_text_without_white_space_is_found_at_any_offset(spark, before):
    rng = random.Random(7)
    run = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(400))
    other = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(400))
    rows = [(1, run), (2, before + run), (3, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b, c = (
        {p["hash"] for p in r.fingerprint} for r in winnowing.fingerprints(df).orderBy("doc_id").collect()
    )
    # All windows within the run are the same; a few at its start may differ.
    assert len(a) > 100 and len(a & b) >= len(a) - winnowing.WINDOW and not a & c


def test_tokens(spark):
    word, run = "w" * winnowing.LONGEST_WORD, "r" * winnowing.LONGEST_WORD + "s"
    cases = {"a bc\td\n": 3, word: 1, f"{word} {word}": 2, run: len(run), f"a {run} b": len(run) + 2, " ": 0, "": 0}
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    n = F.size(F.regexp_extract_all("text", F.lit(winnowing._TOKEN), F.lit(0)))
    assert {r[0]: r[1] for r in df.select("text", n).collect()} == cases


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_next_row_in_descending_order(spark, odd_docs, texts, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(k * 17 - 900, t) for k, t in texts.items()] + [(5, "again"), (5, "")]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        got = winnowing.with_next(df).collect()
        order = sorted(rows, key=lambda r: (-r[0], r[1]))
        want = {(*row, order[(k + 1) % len(order)][1]) for k, row in enumerate(order)}
        assert {tuple(r) for r in got} == want and len(got) == len(rows)
        odd = winnowing.with_next(odd_docs).collect()
        assert len(odd) == 10 and all(r.text is not None and r.next_text is not None for r in odd)
        one = df.where("doc_id = -900")
        assert [r.next_text for r in winnowing.with_next(one).collect()] == [texts[0]]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(odd_docs, no_docs):
    got = {r.doc_id: r.fingerprint for r in winnowing.fingerprints(odd_docs).collect()}
    assert got[1] == got[2] == got[3] == [] and got[5] == got[6] and len(got[7]) > 5
    assert winnowing.fingerprints(no_docs).count() == 0 and winnowing.with_next(no_docs).count() == 0


def test_query(spark, texts):
    got = {r.doc_id: r for r in queries.op1_winnowing(spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    assert len(got) == len(ids)
    for k, doc in enumerate(ids):
        text, after = texts[doc], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[doc].near_next <= 1 and 0 <= got[doc].near_edited <= 1
        own, changed, following = ({int(v, 16) >> winnowing.PLACE_BITS for v in f.split()} for f in (
            got[doc].fingerprint, got[doc].edited_fingerprint, got[ids[(k + 1) % len(ids)]].fingerprint
        ))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert got[doc].near_edited == pytest.approx(like(own, changed))
        assert got[doc].near_next == pytest.approx(like(own, following))
    same: dict = {}
    for doc in ids:
        assert same.setdefault(texts[doc], got[doc].fingerprint) == got[doc].fingerprint
    long_ones = [r for r in got.values() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next + 0.1 for r in long_ones) > 0.95 * len(long_ones)


def test_main_path_is_native(spark):
    plan = queries.op1_winnowing(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
