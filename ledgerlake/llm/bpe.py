"""Byte-level BPE encoding and decoding; distinct words are encoded along a trie of prefixes."""

from __future__ import annotations

import itertools
import json
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: how texts fall into words before merging.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Words whose encoding a task keeps; beyond it the memory is emptied and filled anew.
KEPT_WORDS = 300_000
#: Rows that a task splits and encodes at once.
STEP_ROWS = 512


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, as letter to byte.

    Printable bytes stand for themselves, the others in order for the letters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens as bytes, merge ranks and special tokens of a byte-level BPE file's content."""

    def __init__(self, content: str):
        data = json.loads(content)
        model, letters = data["model"], byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {to_bytes(token): k for token, k in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {k: token for token, k in self.ids.items()}
        self.tokens |= {k: text.encode() for text, k in self.special.items()}
        self.longest = max(map(len, self.ids))
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[to_bytes(a), to_bytes(b)] = rank

    def merged(self, word: bytes) -> list[bytes]:
        """The tokens of a short word, merging the pair of lowest rank again and again."""
        parts = [word[k : k + 1] for k in range(len(word))]
        never = len(self.ranks)
        while len(parts) > 1:
            rank, at = min(
                (self.ranks.get(pair, never), k)
                for k, pair in enumerate(zip(parts, parts[1:], strict=False))
            )
            if rank == never:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class TrieEncoder:
    """Encodes sorted distinct words while walking the trie that they span, depth first.

    The state of a node is the last token of its prefix's encoding. A prefix ends in the one token
    whose preceding prefix ends in a token that stays apart from it when both are merged; so a
    node's state follows from the states above it, and prefixes that words share are done once.
    Only the path to the current node is held: words in order visit the trie depth first.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split: dict[bytes, tuple[int, bytes, bytes]] = {}
        for (a, b), rank in vocabulary.ranks.items():
            self.split.setdefault(a + b, (rank, a, b))
        self.sides: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self.apart: dict[int, bool] = {}

    def _side(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts at one end (1: left, 2: right) of a token while it is merged from bytes, each
        with the rank of the merge that takes it up; the token itself is not taken up."""
        known = self.sides.get((token, side))
        if known is None:
            known, part, rank = [], token, len(self.v.ranks)
            while True:
                known.append((part, rank))
                if part not in self.split:
                    break
                rank, *halves = self.split[part]
                part = halves[side - 1]
            known.reverse()
            self.sides[token, side] = known
        return known

    def _stay_apart(self, a: bytes, b: bytes) -> bool:
        """Whether merging the bytes of two tokens side by side gives these two tokens.

        Walks the parts that touch over time: they merge across the boundary if their pair ranks
        before what takes them up on their own sides; of equal ranks the leftmost is merged first.
        """
        left, right = self._side(a, 2), self._side(b, 1)
        ranks, never = self.v.ranks, len(self.v.ranks)
        i = j = 0
        while True:
            x, until_x = left[i]
            y, until_y = right[j]
            rank = ranks.get((x, y), never)
            if rank < until_x and rank <= until_y and rank < never:
                return False
            if until_x == never and until_y == never:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def _check(self, a: int, b: int, token: bytes) -> bool:
        if len(self.apart) >= 500_000:
            self.apart.clear()
        found = self.apart[a << 32 | b] = (
            self._stay_apart(self.v.tokens[a - 1], token) if a else self.v.merged(token) == [token]
        )
        return found

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word; `words` distinct and in ascending order."""
        known, longest, apart, check = self.v.ids.get, self.v.longest, self.apart.get, self._check
        out = []
        path, widths = [0], [0]  # of each prefix: its last token's id + 1, and its width
        before = b""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del path[shared + 1 :], widths[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                # Exactly one token fits; the last one with a byte more is tried first.
                grown = end - 1 - widths[end - 1]
                for start in itertools.chain(
                    (grown,), range(end - longest if end > longest else 0, end)
                ):
                    token = word[start:end]
                    k = known(token)
                    if k is not None:
                        a = path[start]
                        fits = apart(a << 32 | k)
                        if fits is None:
                            fits = check(a, k, token)
                        if fits:
                            path.append(k + 1)
                            widths.append(end - start)
                            break
            found, end = [], len(word)
            while end:
                found.append(path[end] - 1)
                end -= widths[end]
            found.reverse()
            out.append(found)
            before = word
        return out


class _Numbers(dict):
    """Words numbered in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class BatchEncoder:
    """Encodes lists of texts; remembers the encoding of words."""

    def __init__(self, vocabulary: Vocabulary, kept_words: int = KEPT_WORDS):
        self.v, self.kept = vocabulary, kept_words
        self.trie = TrieEncoder(vocabulary)
        self.split = regex.compile(WORDS).findall
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")").split
            if vocabulary.special
            else None
        )
        self._empty()

    def _empty(self) -> None:
        self.number = _Numbers()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Encode the words that were numbered since the last time."""
        first = len(self.starts) - 1
        new = list(itertools.islice(self.number, first, None))
        order = sorted((w.encode(), k) for k, w in enumerate(new) if w not in self.v.special)
        encoded = [[self.v.special[w]] if w in self.v.special else None for w in new]
        for (_, k), ids in zip(order, self.trie.encode([raw for raw, _ in order]), strict=True):
            encoded[k] = ids
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        values = np.fromiter(itertools.chain.from_iterable(encoded), np.int32, int(sizes.sum()))
        self.flat = np.concatenate([self.flat, values])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _words(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.v.special):
            return self.split(text)
        out: list[str] = []
        for k, piece in enumerate(self.cut(text)):
            out += [piece] if k % 2 else self.split(piece)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text k are ids[offsets[k]:offsets[k + 1]]."""
        if len(self.number) > self.kept:
            self._empty()
        get = self.number.__getitem__
        words = [list(map(get, self._words(t))) if t else [] for t in texts]
        self._learn()
        counts = np.fromiter(map(len, words), np.int64, len(words))
        word = np.fromiter(itertools.chain.from_iterable(words), np.int64, int(counts.sum()))
        sizes = self.starts[word + 1] - self.starts[word]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - self.starts[word], sizes)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        return offsets, self.flat[at]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


#: The encoder of a Python worker, kept for its next task on the same vocabulary.
_KEPT: dict[str, BatchEncoder] = {}


def _encoder(name: str, vocabulary) -> BatchEncoder:
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = BatchEncoder(vocabulary.value)
    return _KEPT[name]


def encode(df: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and ids (array of int) of every row's whole text; one row per input row.

    Null and empty texts give an empty array; repeated rows each give a row; other columns are not
    read, so a column named ids does no harm. The strings of special tokens in a text become these
    tokens. Each task walks a trie of the distinct words of some rows at a time and remembers a
    bounded number of words; the vocabulary, which is broadcast, does not grow with the input.
    """
    held = df.sparkSession.sparkContext.broadcast(vocabulary)
    name = uuid4().hex

    def run(batches):
        encoder = _encoder(name, held)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                offsets, ids = encoder.encode(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32())
                )
                yield pa.record_batch([part.column(0), lists], names=["key", "ids"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`key`, `ids` and decoded (string): the text of each row's tokens, special ones included.

    Bytes that are no UTF-8 become the replacement character; ids that the vocabulary lacks are
    left out; a null array gives an empty text.
    """
    held = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        table = held.value.tokens
        most = max(table) + 1
        token = np.array([table.get(k, b"") for k in range(most)], dtype=object)
        for batch in batches:
            texts = []
            for row in batch.column(1):
                known = np.zeros(0, np.int64)
                if row.is_valid:
                    known = row.values.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
                    known = known[(known >= 0) & (known < most)]
                texts.append(b"".join(token[known]).decode("utf-8", "replace"))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["key", "ids", "decoded"],
            )

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
    return out.select(F.col("key").alias(key), F.col("ids").alias(ids), "decoded")
