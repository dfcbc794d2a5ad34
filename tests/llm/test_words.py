import random

import numpy as np

from ledgerlake.llm import words


def test_same_words_same_hashes(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aAbB é\t\n漢") for _ in range(rng.randrange(200))) for _ in range(200)]
    texts += ["", " ", "x" * 5000, "y z" + "x" * 5000, "ab\x1cab\x85ab\u3000ab\x0bab\x0cab"]
    fold = str.maketrans("AB", "ab")
    split = [t.translate(fold).encode().split() for t in texts]
    vocabulary = sorted({w for ws in split for w in ws})
    for chunk in (words.CHUNK, 64):
        monkeypatch.setattr(words, "CHUNK", chunk)
        one = {w: words.word_hashes([w])[0] for w in vocabulary}
        assert all(len(h) == 1 for h in one.values()) and len({int(h[0]) for h in one.values()}) == len(vocabulary)
        hashes, counts = words.word_hashes([t.encode() for t in texts])
        assert counts.tolist() == [len(ws) for ws in split]
        assert np.array_equal(hashes, np.concatenate([one[w] for ws in split for w in ws]))


def test_chunks_do_not_matter(monkeypatch):
    text = [b"some words and " + b"x" * 300 + b" more", b"z" * 1000]
    want = words.word_hashes(text)
    monkeypatch.setattr(words, "CHUNK", 32)
    assert all(np.array_equal(a, b) for a, b in zip(want, words.word_hashes(text), strict=True))
