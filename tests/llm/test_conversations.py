import hashlib
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from ledgerlake.llm import conversations, queries, turn_blocks
from ledgerlake.llm.tables import table

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, output) by trying all edits; rows: (role, text, must go, truncated)."""

    @cache
    def rest(k, state, inserted):
        role, text, gone, cut = rows[k] if k < len(rows) else (None, None, None, None)
        ways = [(0, "", ())] if k == len(rows) and state in ("", "a") else []
        step = lambda cost, letter, line, tail: ways.append((cost + tail[0], letter + tail[1], line + tail[2]))
        to = NEXT[state]
        if inserted < 3:
            step(3, "I", ((NAME[to], ""),), rest(k, to, inserted + 1))
        if k < len(rows):
            step(4, "D", (), rest(k + 1, state, 0))
            if not gone:
                step(3 + 3 * cut, "R", ((NAME[to], text),), rest(k + 1, to, 0))
                if (state + role[:1]) in ("s", "u", "su", "au", "ua") and role:
                    step(3 * cut, "K", ((role, text),), rest(k + 1, role[0], 0))
        return min(ways, default=(10**9, "", ()))

    for k in reversed(range(len(rows))):  # from the back, so that no call goes deep
        rest(k, "u", 0)
    return rest(0, "", 0)


def plain(rows):
    """The query's rows, from (conv_id, turn, role, text)."""
    out = {conv: [] for conv, *_ in rows}
    text_of = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, found in out.items():
        mark = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, mark(r)))
        seen, judged, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        turns = {r[0] for r in found} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(judged)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        yield conv, gaps, *faults.values(), illegal, cost, audit, sha


def query(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: df)
    return sorted((tuple(r) for r in queries.op11_turn_blocks(spark, "").collect()), key=repr)


def made(seed, conv, n):
    rng = random.Random(seed)
    texts = ["", " ", "Yes.", "no", "And then?", "\t\n", "so", "Fine!", *[f"Text {k}." for k in range(9)]]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "umpire", None]
    return [(conv, k if rng.random() < 0.9 else rng.randrange(n), rng.choice(roles), rng.choice(texts)) for k in range(n)]


def test_query_equals_trying_all_edits(spark, monkeypatch):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert query(spark, df, monkeypatch) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_short_and_long_conversations(spark, monkeypatch, seed):
    rows = [r for c in range(40) for r in made(seed * 100 + c, c, 1 + c % 13)]
    rows += made(seed, 99, 250) + [(None, *r[1:]) for r in made(seed, 0, 30)]
    rows += [(7, None, "user", "Late."), (7, None, None, None), (500, 3, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    clash = df.selectExpr("*", *[f"'x' AS {c}" for c in ("conv", "mark", "_at", "place", "edits", "what", "part")])
    assert query(spark, clash, monkeypatch) == sorted(plain(rows), key=repr)


def test_one_conversation_fills_all_ranges(spark, monkeypatch):
    """Also with one turn in most of its rows."""
    rows = made(3, 1, 300) + [(1, 5, "user", "Again and again.")] * 400
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    turns = conversations._with_duplicates(conversations._turns(df.selectExpr("conv_id AS conv", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text")))
    assert turns.groupBy("part").count().where("count > 200").isEmpty()
    assert query(spark, df, monkeypatch) == sorted(plain(rows), key=repr)


def test_everything_lost_and_empty_table(spark, monkeypatch):
    turns = [t for t in range(400) if zlib.crc32(f"8:{t}".encode()) % 20 == 0]
    rows = [(8, t, "user", "Hello.") for t in turns]
    df = spark.createDataFrame(rows, SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert query(spark, df, monkeypatch) == [(8, 0, 0, 0, 0, 0, 0, "", empty)]
    assert query(spark, df.where("false"), monkeypatch) == []


def test_edits_and_very_long_text(spark):
    long_text = "word " * 400_000 + "end."
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", long_text), (1, 3, "user", long_text), (1, 4, "assistant", "Bye")]
    got = conversations.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.turn, r.edit, r.role, r.fault, r.illegal) for r in got] == [
        (None, "I", "user", None, False),
        (0, "K", "assistant", None, False),
        (1, "K", "user", None, False),
        (3, "D", "user", "duplicate", True),
        (4, "K", "assistant", "truncated", False),
    ]
    assert got[2].text == long_text and got[3].text is None


def test_blocks_equal_single_turns():
    rng = random.Random(4)
    t = turn_blocks.tables()
    for _ in range(200):
        kinds = np.array([rng.randrange(turn_blocks.KINDS) for _ in range(rng.randrange(30))], np.uint8)
        found = np.arange(len(t.step))
        for kind in kinds[::-1]:
            found = t.step[found, kind]
        assert (turn_blocks.vectors_before(kinds) == found).all()
