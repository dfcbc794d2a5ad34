import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, queries
from tests.llm.conftest import SF

PATH = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def encoded(encoder, texts):
    offsets, ids = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def odd_texts():
    rng = random.Random(3)
    texts = ["", " ", "  \n\n x\t\t", "a<|endoftext|>b <|endoftext|><|endoftext|>", "\x1c\x85​é漢字🎉👍🏽  "]
    texts += ["a" * 3000, "ÃÂ" * 200, "''s'll I'VE don't", "the" * 500 + " ", "12345 ½²３"]
    texts += ["".join(rng.choice("ab \n'stre12é漢") for _ in range(4000))]
    texts += ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(60)) for _ in range(100)]
    return texts


def test_encodes_as_the_library(vocabulary, library, texts):
    many = odd_texts() + list(texts.values())
    want = [e.ids for e in library.encode_batch(many, add_special_tokens=False)]
    assert encoded(bpe.BatchEncoder(vocabulary), many) == want
    # With a memory that is emptied again and again.
    small = bpe.BatchEncoder(vocabulary, kept_words=50)
    assert [encoded(small, [t])[0] for t in many[:60]] == want[:60]


def test_prefix_states_give_the_merges_result(vocabulary):
    rng = random.Random(5)
    words = sorted({bytes(rng.choice(b"aeinrst o") for _ in range(rng.randrange(1, 14))) for _ in range(2000)})
    got = bpe.TrieEncoder(vocabulary).encode(words)
    assert [[vocabulary.tokens[k] for k in ids] for ids in got] == [vocabulary.merged(w) for w in words]


def test_round_trip_and_odd_rows(vocabulary, odd_docs, no_docs):
    rows = bpe.decode(bpe.encode(odd_docs, vocabulary), vocabulary)
    got = sorted((r.doc_id or 0, r.decoded) for r in rows.collect())
    want = sorted((r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    assert got == want
    assert bpe.encode(no_docs, vocabulary).count() == 0


def test_decodes_as_the_library(spark, vocabulary, library):
    rng = random.Random(9)
    lists = [[rng.randrange(50257) for _ in range(30)] for _ in range(50)] + [[], [50256], [0, 255, 188]]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, vocabulary).collect()}
    assert got == {k: library.decode(ids, skip_special_tokens=False) for k, ids in enumerate(lists)}
    strange = spark.createDataFrame([(1, [64, -1, 99999, None]), (2, None)], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(strange, vocabulary).collect()} == {1: "a", 2: ""}


def test_query(spark, texts, library):
    import hashlib

    got = {r.doc_id: r for r in queries.op3_bpe(spark, SF).collect()}
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
