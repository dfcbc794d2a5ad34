import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import queries, toxicity
from ledgerlake.llm.tables import table


def made(n, seed):
    """Texts of made-up words; toxic ones hold a word that begins with gromp or is vile."""
    rng = random.Random(seed)
    syllables = ["ta", "lo", "mi", "ren", "su", "gro", "vi", "el"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randrange(3, 120))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                bad = "vile" if rng.random() < 0.5 else "gromp" + word()
                words.insert(rng.randrange(len(words) + 1), bad)
        rows.append((k, " ".join(words).capitalize() + ".", int(toxic)))
    return rows


def test_held_out_rows_are_told(spark):
    rows = made(1500, 1)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    tagger = toxicity.learn(df.drop("toxic"), df.drop("text"))
    got = toxicity.score_documents(df, tagger).join(df.select("doc_id", "toxic"), "doc_id")
    held = got.where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(held) > 300
    assert sum((r.score >= 0.7) == bool(r.toxic) for r in held) >= 0.98 * len(held)
    texts = {r[0]: r[1] for r in rows}
    found = [texts[r.doc_id][s["start"] : s["end"]].lower() for r in held if r.toxic for s in r.spans]
    assert found and sum("vile" in s or "gromp" in s for s in found) >= 0.95 * len(found)


def test_held_out_is_the_checksum(spark):
    ids = [*range(-50, 500), 2**40, None]
    rows = spark.createDataFrame([(k,) for k in ids], "doc_id long").select("doc_id", toxicity.held_out(F.col("doc_id")))
    got = {r[0]: r[1] for r in rows.collect()}
    assert got == {k: zlib.crc32(("" if k is None else str(k)).encode()) % 3 == 1 for k in ids}
    assert 100 < sum(got.values()) < 300


def test_what_is_learned_from_is_bounded(spark, monkeypatch):
    """At most so many rows of each class, one text an id, none held out or too long; the same however
    the rows are dealt."""
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.append((texts, toxic)))
    rows = [(k, f"text {k}", int(k % 3 == 0)) for k in range(600)]
    docs = [r[:2] for r in rows] + [(0, f"another {k}") for k in range(500)] + [(None, "no id")] * 3
    docs += [(3, None), (6, ""), (9, "long " * 10_000)]
    labels = [(r[0], r[2]) for r in rows] + [(1, 1), (2, None), (None, 1), (4, 0), (4, 0)]
    for parts in (1, 5):
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
        m = spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts)
        toxicity.learn(d, m, toxic_rows=600, clean_rows=600)
        toxicity.learn(d, m, toxic_rows=20, clean_rows=50)
    assert seen[0] == seen[2] and seen[1] == seen[3]
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 == 1]
    texts, toxic = seen[0]
    assert len(texts) == 600 - len(held) and not {t.decode() for t in texts} & {f"text {k}" for k in held}
    assert sum(t.startswith(b"another") or t == b"text 0" for t in texts) == (0 not in held)
    assert dict(zip(texts, toxic, strict=True)).get(b"text 1", 1) == 1
    texts, toxic = seen[1]
    assert sum(toxic) == 20 and len(toxic) == 70


def test_query_on_held_out_rows(spark):
    """The registered query: precision and recall over labelled rows that nothing was learned from."""
    sf_dir = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    rows = queries.op10_toxicity(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, marks[r.doc_id]) for r in rows if r.held_out and marks.get(r.doc_id) is not None]
    caught, wrong = held.count((1, 1)), held.count((1, 0))
    assert caught >= 0.85 * (caught + held.count((0, 1)))
    assert wrong <= 0.02 * (wrong + held.count((0, 0)))


def exhaustive(odds, moves):
    n = len(odds)
    weight = {}
    for code in range(2**n):
        states = [code >> k & 1 for k in range(n)]
        w = np.prod([odds[k] ** s for k, s in enumerate(states)])
        w *= np.exp(sum(moves[a, b] for a, b in zip(states, states[1:])))
        # The first state is entered from clean.
        w *= np.exp(moves[0, states[0]])
        weight[code] = w
    total = sum(weight.values())
    return [sum(w for code, w in weight.items() if code >> k & 1) / total for k in range(n)]


def test_marginals_equal_summing_over_all_taggings():
    rng = np.random.default_rng(0)
    moves = rng.normal(size=(2, 2))
    tagger = toxicity.SpanTagger(np.zeros(1), moves, np.zeros(3))
    emissions = [rng.normal(size=n) for n in (1, 2, 5, 7, 0, 6)]
    got = list(toxicity.document_marginals(tagger, emissions))
    for e, m in zip(emissions, got, strict=True):
        assert len(e) == len(m)
        if len(e):
            assert np.allclose(m, exhaustive(np.exp(e), moves))


def test_odd_rows(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    tagger = toxicity.learn(odd_docs, nothing)
    rows = toxicity.score_documents(odd_docs, tagger, carry=["score", "n_tokens"]).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert {r.row.n_tokens for r in rows} >= {1, 2, 3}
    assert toxicity.score_documents(no_docs, tagger).count() == 0
    strange = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (5, 0)], "doc_id long, toxic int")
    toxicity.learn(odd_docs, strange)


def test_offsets_are_code_points():
    text = "ééé vile—vile x".encode()
    words = toxicity.tokens(text)
    spans = toxicity._offsets(text, np.array(["vile" in w.decode() for w in words]))
    assert [text.decode()[s["start"] : s["end"]] for s in spans] == ["vile—vile"]
