"""Toxic spans by a linear-chain conditional random field, and scores of documents from them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.tables import carried

#: Labelled rows of each class that the tagger learns from, at most so many, those of smallest hash
#: of their ids, and the longest text among them in bytes. Scoring covers all rows and whole texts.
TOXIC_ROWS, CLEAN_ROWS, LONGEST = 1_200, 4_000, 1 << 15
#: Weights of the features, which are hashed.
WEIGHTS = 1 << 21
#: Lengths of a word's beginnings and ends that are features beside the word itself.
HEADS, TAILS = (3, 4, 5, 6, 7), (3, 4, 5)
#: Words whose emission a task keeps.
KEPT_WORDS = 500_000
#: Tokens of one sequence in training.
TRAINING_TOKENS = 128
ROUNDS = 60
#: Sequences that are walked side by side in training.
_PIECES = 1024

_WORDS = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CAP = 30.0


def features(word: bytes) -> list[int]:
    """Places of the weights of a word's features."""
    text = word.decode("utf-8", "replace").lower()
    names = [f"={text}"]
    names += [f"{text[:k]}*" for k in HEADS if len(text) >= k]
    names += [f"*{text[-k:]}" for k in TAILS if len(text) >= k]
    return [xxhash.xxh32_intdigest(name) % WEIGHTS for name in names]


def tokens(text: bytes) -> list[bytes]:
    """Runs of letters: ASCII ones and everything beyond ASCII."""
    return text.translate(_WORDS).split()


class Chain(NamedTuple):
    """Sequences of emissions side by side: row t holds the t-th of each; `live` where there is one."""

    odds: np.ndarray
    live: np.ndarray


def side_by_side(emissions: list[np.ndarray]) -> Chain:
    most = max(map(len, emissions))
    odds = np.ones((most, len(emissions)))
    live = np.zeros((most, len(emissions)), bool)
    for k, e in enumerate(emissions):
        odds[: len(e), k] = np.exp(np.clip(e, -_CAP, _CAP))
        live[: len(e), k] = True
    return Chain(odds, live)


class SpanTagger(NamedTuple):
    """Weights of the features, log potentials of moves between the states clean (0) and toxic (1),
    and what turns marginals into a document's score."""

    weights: np.ndarray
    moves: np.ndarray
    scale: np.ndarray

    def emission(self, word: bytes) -> float:
        return float(self.weights[features(word)].sum())

    def marginals(self, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: (odds of toxic at each place, odds of what follows), before combining.

        Both passes carry the odds of the two states; a place's marginal odds are the product of
        its forward odds and the backward odds.
        """
        (a00, a01), (a10, a11) = np.exp(self.moves)
        odds, live = chain
        ahead, back = np.ones_like(odds), np.ones_like(odds)
        now = (a01 + a11 * 0) / a00 * odds[0]
        ahead[0] = now
        for t in range(1, len(odds)):
            now = odds[t] * (a01 + a11 * now) / (a00 + a10 * now)
            ahead[t] = now
        after = np.ones(odds.shape[1])
        for t in range(len(odds) - 2, -1, -1):
            seen = odds[t + 1] * after
            after = np.where(live[t + 1], (a10 + a11 * seen) / (a00 + a01 * seen), 1.0)
            back[t] = after
        return ahead, back

    def score(self, evidence: np.ndarray) -> np.ndarray:
        """Scores from `evidence` (rows: see `document_evidence`)."""
        z = evidence @ self.scale[1:] + self.scale[0]
        return 1 / (1 + np.exp(-np.clip(z, -_CAP, _CAP)))


def document_evidence(marginals: np.ndarray) -> tuple[float, float]:
    """Log odds of the likeliest toxic token, and the logarithm of the expected number of them."""
    if not len(marginals):
        return -8.0, -8.0
    top = min(max(float(marginals.max()), 1e-4), 1 - 1e-4)
    return np.log(top / (1 - top)), max(-8.0, float(np.log(marginals.sum() + 1e-9)))


def _documents_apart(texts: Iterable[bytes]) -> list[int]:
    """Positions of texts of which no earlier one has the same smallest hash of word pairs."""
    seen, kept = set(), []
    for k, text in enumerate(texts):
        words = tokens(text)
        pairs = {xxhash.xxh3_64_intdigest(b" ".join(p)) for p in zip(words, words[1:], strict=False)}
        mark = min(pairs, default=hash(tuple(words)))
        if mark not in seen:
            seen.add(mark)
            kept.append(k)
    return kept


class _Sample:
    """The learning texts as numbers of word types, and the features of the types."""

    def __init__(self, texts: list[bytes], toxic: list[int]):
        number: dict[bytes, int] = {}
        self.docs = [
            np.array([number.setdefault(w, len(number)) for w in tokens(t)], np.int32) for t in texts
        ]
        self.toxic = np.array(toxic, bool)
        sizes: list[int] = []

        def flat() -> Iterator[int]:
            for word in number:
                found = features(word)
                sizes.append(len(found))
                yield from found

        #: The features that occur, and by word type, one behind the other, which of them it has.
        self.used, place = np.unique(np.fromiter(flat(), np.int32), return_inverse=True)
        self.place = place.astype(np.int32)
        self.sizes = np.array(sizes, np.int64)
        self.owner = np.repeat(np.arange(len(sizes), dtype=np.int32), self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def telling(self, least: int = 5, share: float = 0.01, pure: float = 0.99) -> np.ndarray:
        """Whether a word type has a feature that toxic documents have and clean ones hardly."""
        counts = np.zeros((2, len(self.used)))
        for words, toxic in zip(self.docs, self.toxic, strict=True):
            types = np.unique(words)
            if not len(types):
                continue
            sizes = self.sizes[types]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(self.starts[types] - ends + sizes, sizes)
            counts[int(toxic), np.unique(self.place[at])] += 1
        n_toxic = max(1, int(self.toxic.sum()))
        n_clean = max(1, len(self.docs) - n_toxic)
        enough = counts[1] >= max(least, share * n_toxic)
        rate = counts[1] / n_toxic
        strong = enough & (rate >= pure * (rate + counts[0] / n_clean))
        out = np.zeros(len(self.sizes), bool)
        out[self.owner[strong[self.place]]] = True
        return out


def fit(texts: list[bytes], toxic: list[int]) -> SpanTagger:
    """Learn from documents and their labels.

    Tokens are labelled first: those of toxic documents with a feature that nearly only toxic
    documents have are toxic, all others clean. The field is then fitted to these by gradient steps
    on the regularised likelihood, with marginals from forward-backward; at last a logistic scale
    from the marginals of the documents to their labels. Without documents of both classes the
    score is their smoothed share.
    """
    n_toxic = sum(toxic)
    flat = np.array([np.log((n_toxic + 1) / (len(toxic) - n_toxic + 1)), 0.0, 0.0])
    nothing = SpanTagger(np.zeros(WEIGHTS, np.float32), np.zeros((2, 2)), flat)
    if not n_toxic or n_toxic == len(toxic):
        return nothing
    apart = _documents_apart(texts)
    sample = _Sample([texts[k] for k in apart], [toxic[k] for k in apart])
    telling = sample.telling()
    if not telling.any():
        return nothing
    pieces, marks = [], []
    for words, is_toxic in zip(sample.docs, sample.toxic, strict=True):
        for at in range(0, len(words), TRAINING_TOKENS):
            piece = words[at : at + TRAINING_TOKENS]
            pieces.append(piece)
            marks.append(telling[piece] & is_toxic)
    most = max(map(len, pieces))
    word = np.zeros((most, len(pieces)), np.int32)
    live, mark = np.zeros(word.shape, bool), np.zeros(word.shape, bool)
    for k, (piece, m) in enumerate(zip(pieces, marks, strict=True)):
        word[: len(piece), k], live[: len(piece), k], mark[: len(piece), k] = piece, True, m
    weights, moves = _fit_field(sample, word, live, mark)
    emission = np.add.reduceat(weights[sample.place], sample.starts)
    full = np.zeros(WEIGHTS, np.float32)
    full[sample.used] = weights
    tagger = SpanTagger(full, moves, flat)
    evidence = np.array(
        [
            document_evidence(m)
            for m in document_marginals(tagger, [emission[words] for words in sample.docs])
        ]
    )
    return tagger._replace(scale=_fit_scale(evidence, sample.toxic))


def _fit_field(sample: _Sample, word, live, mark) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features that occur, and moves, by gradient steps over all pieces."""
    place, n_used, n_types = sample.place, len(sample.used), len(sample.sizes)
    weights, moves = np.zeros(n_used), np.zeros((2, 2))
    total, total_moves = np.full(n_used, 1e-6), np.full((2, 2), 1e-6)
    n = float(live.sum())
    seen = np.bincount(word[mark], minlength=n_types).astype(float)
    both = live[1:] & live[:-1]
    seen_moves = np.array(
        [[((mark[:-1] == a) & (mark[1:] == b) & both).sum() for b in (False, True)] for a in (False, True)]
    )
    for _ in range(ROUNDS):
        emission = np.exp(np.clip(np.add.reduceat(weights[place], sample.starts), -_CAP, _CAP))
        expected, counts = np.zeros(n_types), np.zeros((2, 2))
        for at in range(0, word.shape[1], _PIECES):
            part = slice(at, at + _PIECES)
            found = _expected(emission, moves, word[:, part], live[:, part])
            expected += found[0]
            counts += found[1]
        gradient = np.bincount(place, np.repeat(seen - expected, sample.sizes), n_used) - 0.05 * weights
        move_gradient = (seen_moves - counts - 0.05 * moves) / n
        total += gradient**2
        total_moves += move_gradient**2
        weights += 0.5 * gradient / np.sqrt(total)
        moves = moves + 0.2 * move_gradient / np.sqrt(total_moves)
    return weights, moves


def _expected(emission, moves, word, live) -> tuple[np.ndarray, np.ndarray]:
    """How many toxic tokens of each word type, and moves, the field expects in some pieces."""
    odds = np.where(live, emission[word], 1.0)
    none = np.zeros(1)
    ahead, back = SpanTagger(none, moves, none).marginals(Chain(odds, live))
    joint = ahead * back
    marginal = joint / (1 + joint)
    # Of a pair of neighbours: P(b | a) by the odds of what follows b.
    follow, a = odds[1:] * back[1:], np.exp(moves)
    here, both = (1 - marginal[:-1], marginal[:-1]), live[1:] & live[:-1]
    counts = np.zeros((2, 2))
    for k in (0, 1):
        toxic = a[k, 1] * follow / (a[k, 0] + a[k, 1] * follow)
        counts[k] = ((1 - toxic) * here[k])[both].sum(), (toxic * here[k])[both].sum()
    return np.bincount(word[live], marginal[live], len(emission)), counts


def _fit_scale(evidence: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with a weak pull to zero, by Newton steps; classes count as given."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    w = np.zeros(x.shape[1])
    pull = 0.1 * np.eye(len(w))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -_CAP, _CAP)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + pull
        w = w + np.linalg.solve(hessian, x.T @ (toxic - p) - pull @ w)
    return w


def document_marginals(tagger: SpanTagger, emissions: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Probabilities of toxic for the tokens of each document, in the given order.

    Documents of like length are walked side by side, a token of each at a time.
    """
    order = sorted(range(len(emissions)), key=lambda k: len(emissions[k]))
    out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
    at = 0
    while at < len(order):
        if not len(emissions[order[at]]):
            at += 1
            continue
        end, area = at, 0
        shortest = len(emissions[order[at]])
        while end < len(order):
            length = len(emissions[order[end]])
            if end > at and (length > 1.3 * shortest + 16 or area + length > 2_000_000):
                break
            area += length
            end += 1
        group = order[at:end]
        chain = side_by_side([emissions[k] for k in group])
        ahead, back = tagger.marginals(chain)
        joint = ahead * back
        marginal = joint / (1 + joint)
        for column, k in enumerate(group):
            out[k] = marginal[: len(emissions[k]), column].copy()
        at = end
    yield from out


class _Emissions(dict):
    """Emissions of words, remembered."""

    def __init__(self, tagger: SpanTagger):
        super().__init__()
        self.tagger = tagger

    def __missing__(self, word: bytes) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = self.tagger.emission(word)
        return value


def _offsets(text: bytes, toxic: np.ndarray) -> list[dict]:
    """Runs of toxic tokens as [start, end) in code points."""
    data = np.frombuffer(text, np.uint8)
    letter = np.frombuffer(text.translate(_WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    runs = np.diff(np.concatenate([[0], toxic.view(np.int8), [0]]))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    return [
        {"start": int(point[begin[a]]), "end": int(point[end[b]])}
        for a, b in zip(first, last, strict=True)
    ]


#: Documents whose marginals a task holds at once.
_AT_ONCE = 1024


def score_documents(
    docs: DataFrame,
    tagger: SpanTagger,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """`doc_id`, score (0 to 1), n_tokens and spans (array of start, end: code points of runs of
    tokens that are rather toxic than not) of every row's whole text.

    Null and empty texts have no tokens and the score of nothing found; repeated rows and equal
    texts score alike; other columns are not read. The tagger, which is broadcast, has a fixed size.
    """
    held = docs.sparkSession.sparkContext.broadcast(tagger)
    rows = docs.select(
        F.col(doc_id).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw"),
        *carried(carry),
    )
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        tagger = held.value
        known = _Emissions(tagger)
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                texts = part.column(1).to_pylist()
                emissions = []
                for raw in texts:
                    words = tokens(raw)
                    emissions.append(
                        np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                    )
                evidence, spans = [], []
                for raw, m in zip(texts, document_marginals(tagger, emissions), strict=True):
                    evidence.append(document_evidence(m))
                    toxic = m >= 0.5
                    spans.append(_offsets(raw, toxic) if toxic.any() else [])
                columns = [
                    part.column(0),
                    pa.array(tagger.score(np.array(evidence))),
                    pa.array([len(e) for e in emissions], pa.int64()),
                    pa.array(spans, span),
                    *part.columns[2:],
                ]
                yield pa.record_batch(columns, names=names)

    schema = StructType.fromDDL("score double, n_tokens long, spans array<struct<start:int,end:int>>")
    schema = StructType([rows.schema["key"], *schema, *rows.schema.fields[2:]])
    names = schema.fieldNames()
    return rows.mapInArrow(run, schema).withColumnRenamed("key", doc_id)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    longest: int = LONGEST,
) -> SpanTagger:
    """A tagger from labelled rows that are not held out.

    It learns from `toxic_rows` and `clean_rows` of them at most, texts of up to `longest` bytes,
    those of smallest hash of their ids: what reaches the driver has at most toxic_rows + clean_rows
    rows of `longest` bytes, and is the same when the job runs again. An id with several labels counts
    as toxic if one says so; null labels are left out; of an id with several texts the one of
    smallest hash is taken. Of texts that share their smallest hash of word pairs, as copies do, the
    first is learned from.
    """
    known = (
        labels.select(F.col(doc_id).alias("key"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("key").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("key")))
        .groupBy("key")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("toxic", (F.col("toxic") == 1).cast("int"))
    )
    first = [F.xxhash64("key"), F.col("key")]
    some = {
        toxic: known.where(F.col("toxic") == toxic).orderBy(*first).limit(rows)
        for toxic, rows in ((1, toxic_rows), (0, clean_rows))
    }
    rows = (
        docs.select(F.col(doc_id).alias("key"), F.col(text).cast("string").alias("text"))
        .where(F.octet_length("text").between(1, longest))
        .join(F.broadcast(some[1].unionByName(some[0])), "key")
        .groupBy("key", "toxic")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
        .select("key", "toxic", "first.text")
        .orderBy("key")
    )
    texts, toxic = [], []
    for row in rows.collect():
        texts.append(row["text"].encode())
        toxic.append(row["toxic"])
    return fit(texts, toxic)
