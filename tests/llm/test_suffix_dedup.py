import random
from collections import Counter

import pytest

from ledgerlake.llm import suffix_dedup


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[k : k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for raw in raws:
        hit = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                hit[k : k + length] = b"\1" * length
        edges = [k for k in range(len(raw) + 1) if (k < len(raw) and hit[k]) != (k > 0 and hit[k - 1])]
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        out.append((len(raw), spans, bytes(b for b, h in zip(raw, hit, strict=True) if not h)))
    return out


def pieced(seed, length):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé fgh") for _ in range(rng.randrange(1, 6 * length))) for _ in range(20)]
    texts = [None, "", "a" * (3 * length), "ab" * (2 * length), "é" * length]
    for _ in range(40):
        text = ""
        for _ in range(rng.randrange(1, 5)):
            piece = rng.choice(base)
            if rng.random() < 0.6:
                at = rng.randrange(len(piece))
                text += piece[at : at + rng.randrange(1, 2 * length)]
            else:
                text += "".join(rng.choice("xyz uvé") for _ in range(rng.randrange(1, length)))
        texts.append(text)
    return texts + texts[5:9]


def removed(df, **options):
    rows = suffix_dedup.remove_repeats(df, **options).collect()
    return {r.doc_id: (r.n_bytes, [(s["first"], s["end"]) for s in r.spans], bytes(r.kept)) for r in rows}


@pytest.mark.parametrize(("seed", "length", "step"), [(1, 20, 1 << 16), (2, 20, 90), (3, 200, 1 << 16), (4, 200, 700)])
def test_equals_plain_counting(spark, monkeypatch, seed, length, step):
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    texts = pieced(seed, length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert removed(df, length=length) == dict(enumerate(plain(texts, length)))


def test_given_documents(spark, texts):
    keys = sorted(texts)
    df = spark.createDataFrame([(k, texts[k]) for k in keys], "doc_id long, text string").repartition(4)
    assert removed(df) == dict(zip(keys, plain([texts[k] for k in keys], 200), strict=True))


def test_odd_rows_and_carried_columns(odd_docs, no_docs):
    rows = suffix_dedup.remove_repeats(odd_docs, length=20, carry=["score", "n_tokens"], as_text=True).collect()
    assert len(rows) == 10
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert got[1].kept == got[2].kept == "" and got[1].n_bytes == 0
    assert got[5].kept == "" and got[5].row.n_tokens == 5 and got[6].row.score is None
    assert got[6].kept == "ONE"
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_text_without_cut_characters(spark):
    shared = "é" * 15
    df = spark.createDataFrame([(1, f"aé{shared}"), (2, f"bè{shared}")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(df, length=21, as_text=True).collect()}
    assert kept[1].startswith("a") and "�" not in kept[1] + kept[2]
