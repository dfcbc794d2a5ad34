import random
import re

from ledgerlake.llm import decontamination
from ledgerlake.llm.suffix_automaton import SuffixAutomaton

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def plain(docs, items, window):
    windows = {}
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + k]), set()).add(name)
    out = {}
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in windows:
                    hit |= set(range(at, at + k))
                    found |= windows[tuple(w[at : at + k])]
        out[key] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def sample(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "B", "c1", "é", "d-e"]) for _ in range(n))
    items = [(f"i{k}", text(rng.randrange(0, 12))) for k in range(15)] + [("i3", "a a a"), ("long", text(60))]
    docs = [(k, text(rng.randrange(0, 80))) for k in range(60)]
    docs += [(100 + k, f"zz yy {items[k][1]} xx {items[-1][1]}") for k in range(5)]
    return docs, items


def test_equals_plain_search(spark):
    for seed, window, block in ((1, 4, 1 << 20), (2, 6, 1 << 20), (3, 5, 60)):
        docs, items = sample(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        bench = spark.createDataFrame(items, "item_id string, text string")
        rows = decontamination.decontaminate(df, bench, window=window, block_bytes=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows}
        assert got == plain(docs, items, window)


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    """Pieces of few windows, many automatons, and items just as long as a piece or a window."""
    docs, items = sample(7)
    items += [(f"n{n}", " ".join(f"q{k}" for k in range(n))) for n in (4, 5, 6, 7, 8, 9, 10, 23)]
    docs += [(200, items[-1][1]), (201, "x " + " ".join(f"q{k}" for k in range(9, 16)) + " y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for windows, block in ((1, 1 << 20), (3, 1 << 20), (3, 200)):
        monkeypatch.setattr(decontamination, "ITEM_WINDOWS", windows)
        rows = decontamination.decontaminate(df, bench, window=5, block_bytes=block).collect()
        got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows}
        assert got == plain(docs, items, 5)


def test_automaton_knows_all_substrings():
    rng = random.Random(4)
    lists = [[bytes([rng.choice(b"abc")]) for _ in range(rng.randrange(1, 20))] for _ in range(10)]
    automaton = SuffixAutomaton([(str(k), x) for k, x in enumerate(lists)], 3)
    known = {tuple(x[a:b]) for x in lists for a in range(len(x)) for b in range(a + 1, len(x) + 1)}
    for n in range(1, 6):
        for code in range(3**n):
            word = [bytes([b"abc"[code // 3**k % 3]]) for k in range(n)]
            state = 0
            for w in word:
                state = automaton.next[state].get(automaton.ids.get(w)) if state is not None else None
            assert (state is not None) == (tuple(word) in known)


def test_spans_are_removed(spark):
    df = spark.createDataFrame([(1, "Start, one TWO three - four; end. one two"), (2, None)], "doc_id int, text string")
    items = spark.createDataFrame([(1, "one two three four"), (2, None), (None, "")], "item_id int, text string")
    rows = {r.doc_id: r for r in decontamination.decontaminate(df, items, window=4, longer_than=3).collect()}
    assert rows[1].clean_text == "Start, ; end. one two" and rows[2].clean_text is None
    assert [tuple(s) for s in rows[1].spans] == [(1, 5)] and rows[1].item_ids == ["1"]


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "five SIX seven"), (1, "five six seven"), (2, "漢字")], "item_id int, text string")
    rows = decontamination.decontaminate(odd_docs, items, carry=["score", "n_tokens"]).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 10 and got[5].n_hit == 3 and got[5].item_ids == ["1"] and got[5].row.score == "x"
    assert got[1].n_words == 0 and not got[1].contaminated and got[4].n_words == 160_000
    assert decontamination.decontaminate(no_docs, items).count() == 0
    assert decontamination.decontaminate(odd_docs, items.where("false")).where("n_hit > 0").count() == 0


def test_words_are_split_piece_by_piece(monkeypatch):
    text = ("Ab1 é-漢字_x" * 50).encode()
    want = list(decontamination.words(text))
    monkeypatch.setattr(decontamination, "PIECE", 7)
    assert list(decontamination.words(text)) == want == [w.encode() for w in words(text.decode())]
