"""Words of texts as hashes, many at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once, so that what is computed for them stays in a processor's cache.
CHUNK = 1 << 16
#: Bytes of texts that are taken together.
GROUP = 1 << 18

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
ODD = _A
#: Stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A number for each byte; A-Z have those of a-z.
_LETTER = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(int(_A), 2 * CHUNK)
_DOWN = _powers(pow(int(_A), -1, 1 << 64), 2 * CHUNK)


def _chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of the words of a chunk that ends with white space.

    A word's hash is the sum of its letters' numbers times powers that count from its first letter:
    the difference of two running sums, brought back to the word's beginning.
    """
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]])))
    first, end = edges[::2], edges[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * _UP[: len(data)], out=total[1:])
    raw = (total[end] - total[first]) * _DOWN[first]
    return first, mixed(raw + (end - first).astype(np.uint64) * _C)


def _long_word(data: np.ndarray) -> np.uint64:
    total, up = 0, 1
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK]
        total += up * int(np.sum(_LETTER[part] * _UP[: len(part)]))
        up = up * pow(int(_A), len(part), 1 << 64) % (1 << 64)
    raw = np.array([total % (1 << 64)], np.uint64)
    return mixed(raw + np.array([len(data)], np.uint64) * _C)[0]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes (uint64) of the words of some texts, one text behind the other, and the number of
    each text's words. Words end at ASCII white space; A-Z count as a-z."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    firsts, hashes = [], []
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and not _SPACE[data[end - 1]]:
            gap = np.flatnonzero(_SPACE[data[end : end + CHUNK]])
            end = end + int(gap[0]) + 1 if len(gap) else min(end + CHUNK, len(data))
        if end - at > 2 * CHUNK:
            # The last word of the piece is a long one.
            spaces = np.flatnonzero(_SPACE[data[at : at + CHUNK]])
            begin = at + int(spaces[-1]) + 1 if len(spaces) else at
            if begin > at:
                first, found = _chunk(data[at:begin])
                firsts.append(first + at)
                hashes.append(found)
            firsts.append(np.array([begin]))
            hashes.append(np.array([_long_word(data[begin : end - 1])], np.uint64))
        else:
            first, found = _chunk(data[at:end])
            firsts.append(first + at)
            hashes.append(found)
        at = end
    if not firsts:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.concatenate(firsts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    return np.concatenate(hashes), counts


def groups(batches, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows at a time: their part of a batch, the hashes of their words and how many each has."""
    for batch in batches:
        at, held, size = 0, [], 0
        for k, raw in enumerate(batch.column(column)):
            held.append(raw.as_buffer().to_pybytes())
            size += len(held[-1])
            if size >= GROUP:
                yield batch.slice(at, len(held)), *word_hashes(held)
                at, held, size = k + 1, [], 0
        if held:
            yield batch.slice(at, len(held)), *word_hashes(held)
