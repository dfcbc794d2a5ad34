import random

import __spark_entry__
import corpus_pipeline
from ledgerlake.llm import queries
from ledgerlake.llm.tables import stored, table
from tests.llm.conftest import SF


def test_stages_one_after_the_other(spark):
    docs = table(spark, SF, "documents")
    ids = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.keys() <= before.keys() and len(after) == docs.count()
        if name == "repeated passages":
            assert after.keys() == before.keys()
        else:
            assert all(before[k] == text for k, text in after.items())
    assert 0.5 * len(ids) < docs.count() < len(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}
    assert all(r.n_tokens == len(r.ids) for r in last)


def test_odd_rows(spark, odd_docs, no_docs):
    for df, least in ((odd_docs, 6), (no_docs, 0)):
        docs = df.selectExpr("doc_id", "text", "'en' as lang", "score as source", "n_tokens as n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-odd")
        assert docs.count() >= least


def test_very_long_texts(spark):
    """Megabytes in one row, beside small ones: nothing is lost but what the stages are to take."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(100_000)}" for _ in range(400_000)]
    rows = [(1, " ".join(words)), (2, "short and alone"), (3, " ".join(words[::-1])), (4, None), (5, "")]
    docs = spark.createDataFrame([(k, t, "en", "x", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "test-long")
    found = {r.doc_id: r.text for r in docs.collect()}
    assert found == dict(rows)


def test_of_copies_with_equal_or_no_ids_one_keeps_its_text(spark):
    told = {k: " ".join(f"{k}{j * j % 97} word{j}" for j in range(80)) for k in "abcd"}
    rows = [(1, told["a"])] * 3 + [(None, told["b"])] * 3 + [(2, told["c"]), (None, told["c"] + " end")]
    rows += [(1, told["d"])]  # shares its id with copies
    docs = spark.createDataFrame([(*r, "en", "x", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = stored(corpus_pipeline.apart(spark, docs.repartition(3), SF), "test-apart")
    found = corpus_pipeline.unrepeated(spark, docs, SF).collect()
    want = [(1, told["a"]), (None, told["b"]), (2, told["c"]), (1, told["d"])]
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(want, key=str)


def test_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert set(queries.oracle_sql()) <= set(queries.queries())
