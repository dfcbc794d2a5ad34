"""The cheapest way to bring the turns of a conversation in order, by tables of blocks of turns.

What is left of a conversation is to read `(s?(ua)+)?` by the first letters of its roles. From the
back, a place before a turn has a vector: what the rest costs at least, by what was said last. Taken
less its least entry there are few vectors, so a table tells for each vector behind a block of turns,
and each block, the vector before it. Only the vectors at the ends of blocks are kept; tracing opens
one block after the other.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np

#: What was said last: nothing yet, the system's turn, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Who speaks after it, where a turn is inserted or given to another.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = ("s", "u", "a")
#: Pairs of first letters that may follow each other.
FOLLOW = ("su", "ua", "au")

# What the edits cost, and a truncated turn that stays.
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3

#: Kinds of turns: 0 has to go; else 1 + 2 * who (system, user, assistant, another) + truncated.
KINDS = 9
#: Turns of a block.
BLOCK = 4


def after(state: int, who: int) -> int | None:
    """What was said last once such a turn is kept; None if it may not follow."""
    if who == 0:
        return SYSTEM if state == NOTHING else None
    if who == 1:
        return USER if state != USER else None
    return ASSISTANT if who == 2 and state == USER else None


def _edits(state: int, kind: int) -> list[tuple[str, int, int]]:
    """(edit, its cost, what was said last then) of the edits that take a turn."""
    found = [("D", COST["D"], state)]
    if kind:
        who, more = (kind - 1) // 2, (kind - 1) % 2 * TRUNCATED
        if (kept := after(state, who)) is not None:
            found.append(("K", COST["K"] + more, kept))
        found.append(("R", COST["R"] + more, NEXT[state]))
    return found


def _closed(costs: list[int]) -> tuple[int, ...]:
    """The vector once turns may be inserted."""
    for _ in range(3):
        costs = [min(c, COST["I"] + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


def _before(behind: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """The vector before a turn."""
    return _closed([min(c + behind[to] for _, c, to in _edits(s, kind)) for s in range(4)])


class Tables(NamedTuple):
    end: int  # the vector behind the last turn
    step: np.ndarray  # vector, kind: the vector before the turn
    block: np.ndarray  # vector, block: the vector before the block
    moves: list  # vector behind, kind, state: edits of the turn, state
    tails: tuple[str, ...]  # state: what is inserted at the end


@cache
def tables() -> Tables:
    """All vectors that can occur, and what leads from one to the other; made once in a process."""
    far = 1 << 20
    end = _closed([0, far, far, 0])
    vectors, step, moves = [end], [], []
    for behind in vectors:  # grows on the way
        step.append([])
        moves.append([])
        for kind in range(KINDS):
            before = _before(behind, kind)
            least = tuple(c - min(before) for c in before)
            if least not in vectors:
                vectors.append(least)
            step[-1].append(vectors.index(least))
            moves[-1].append([_move(behind, before, kind, s) for s in range(4)])
    to = np.array(step, np.int16)
    block = np.repeat(np.arange(len(vectors), dtype=np.int16)[:, None], KINDS**BLOCK, axis=1)
    codes = np.arange(KINDS**BLOCK)
    for k in reversed(range(BLOCK)):
        block = to[block, codes // KINDS**k % KINDS]
    return Tables(0, to, block, moves, tuple("I" * (end[s] // COST["I"]) for s in range(4)))


def _move(behind: tuple[int, ...], before: tuple[int, ...], kind: int, state: int) -> tuple[str, int]:
    """The edits of a turn from a state on: of the cheapest the least by letters, D, I, K, R."""
    edits, left = "", before[state]
    while True:
        for edit, cost, to in sorted([*_edits(state, kind), ("I", COST["I"], NEXT[state])]):
            rest = before[to] if edit == "I" else behind[to]
            if cost + rest == left:
                break
        edits, state, left = edits + edit, to, rest
        if edit != "I":
            return edits, state


def _coded(kinds: np.ndarray) -> np.ndarray:
    """The numbers of the whole blocks."""
    whole = kinds[: len(kinds) // BLOCK * BLOCK].reshape(-1, BLOCK).astype(np.int64)
    return whole @ (KINDS ** np.arange(BLOCK))


def vectors_before(kinds: np.ndarray) -> np.ndarray:
    """For each vector that may be behind some turns, the vector before them."""
    t = tables()
    found = np.arange(len(t.step), dtype=np.int16)
    for kind in kinds[len(kinds) // BLOCK * BLOCK :][::-1].tolist():
        found = t.step[found, kind]
    for code in _coded(kinds)[::-1].tolist():
        found = t.block[found, code]
    return found


def trace(kinds: np.ndarray, behind: int, state: int) -> tuple[list[str], int]:
    """The edits of each turn, and what was said last, from a state on with a vector behind the turns."""
    t = tables()
    codes = _coded(kinds).tolist()
    rest = kinds[len(codes) * BLOCK :].tolist()
    ends = [behind]  # behind the rest, behind the last block, ...
    for kind in reversed(rest):
        behind = int(t.step[behind, kind])
    ends.append(behind)
    for code in reversed(codes[1:]):
        behind = int(t.block[behind, code])
        ends.append(behind)
    found: list[str] = []
    for at in range(len(codes)):
        block = kinds[at * BLOCK : (at + 1) * BLOCK].tolist()
        state = _trace_block(t, block, ends[len(codes) - at], state, found)
    return found, _trace_block(t, rest, ends[0], state, found)


def _trace_block(t: Tables, kinds: list[int], behind: int, state: int, found: list[str]) -> int:
    inside = [behind]
    for kind in kinds[:0:-1]:
        inside.append(int(t.step[inside[-1], kind]))
    for kind, vector in zip(kinds, reversed(inside), strict=False):
        edits, state = t.moves[vector][kind][state]
        found.append(edits)
    return state
