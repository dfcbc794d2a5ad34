"""Training texts against benchmark items, by a suffix automaton of the items' words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.llm.suffix_automaton import SuffixAutomaton
from ledgerlake.llm.tables import carried, stored

#: Words are runs of digits, letters a-z and everything beyond ASCII, after lower-casing A-Z.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Bytes of benchmark text in one automaton, which each task holds: 220 MB of memory and more.
BLOCK_BYTES = 2 << 20
#: Windows of an item that are looked for together; a longer item is cut, at no loss of a window.
ITEM_WINDOWS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COLUMNS = ("key", "text", "n_words", "spans", "item_ids")


def words(text: bytes) -> Iterator[bytes]:
    """The words of a text, split piece by piece at bytes that belong to no word."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _FOLD[text[end]] != 32:
            end += 1
        yield from text[at:end].translate(_FOLD).split()
        at = end


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and out[-1][1] >= first:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def without_spans(text: bytes, spans: list[list[int]], longer_than: int) -> bytes:
    """The text without the words of spans of more than `longer_than` words, and what is between."""
    cuts, bounds = [], [m.span() for m in _WORD.finditer(text)]
    for first, end in spans:
        if end - first > longer_than:
            cuts.append((bounds[first][0], bounds[end - 1][1]))
    kept, at = [], 0
    for first, end in cuts:
        kept.append(text[at:first])
        at = end
    return b"".join([*kept, text[at:]])


def _scan(df: DataFrame, automaton) -> DataFrame:
    """Add what one automaton finds to the spans and items found so far."""

    def run(batches):
        scan = automaton.value.scan
        for batch in batches:
            known = (batch.column(k) for k in (1, 3, 4))
            count, spans, items = [], [], []
            for text, before, named in zip(*(c.to_pylist() for c in known), strict=True):
                n, found, new = scan(words((text or "").encode()))
                count.append(n)
                spans.append(_merged([[s["first"], s["end"]] for s in before] + found))
                items.append(sorted({*named, *new}))
            pairs = [[{"first": a, "end": b} for a, b in row] for row in spans]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(count, pa.int64()),
                    pa.array(pairs, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                    pa.array(items, pa.list_(pa.string())),
                    *batch.columns[len(_COLUMNS) :],
                ],
                names=names,
            )

    names = df.columns
    return df.mapInArrow(run, df.schema)


def _pieces(items: DataFrame, window: int) -> DataFrame:
    """id and text of items, long ones as pieces of which each begins with other windows."""
    folded = F.translate("text", _UPPER, _LOWER)
    found = F.regexp_extract_all(folded, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)), F.lit(ITEM_WINDOWS))
    piece = F.slice("words", F.col("start") + 1, ITEM_WINDOWS + window - 1)
    return (
        items.select("id", found.alias("words"))
        .where(n > 0)
        .select("id", "words", F.explode(starts).alias("start"))
        .select("id", F.array_join(piece, " ").alias("text"))
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    longer_than: int | None = None,
    share: int = 20,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """What of each document occurs in benchmark items; one row per document, in no order.

    A window is `window` consecutive words of an item, or a whole item of fewer words; a document
    word inside any occurrence of a window is hit. Returns `doc_id`, n_words, n_hit, spans
    (array of first, end: words, merged), item_ids (array of strings, sorted: items with a window
    that occurs) and contaminated (n_hit > 0 and share * n_hit >= n_words). With `longer_than`,
    also clean_text: the text without hit spans of more than so many words.

    Null and empty texts have no words, no hits and a null or empty clean_text; items without words
    or without id match nothing by name (the words of an item without id still count as hits under
    the name ""); repeated items and rows each count as given. Other columns are not read, but those
    named in `carry`, which come along in a struct named row.

    Documents stream through the tasks and are not shuffled. An automaton is built from at most
    `block_bytes` of item text (measured first; long items are cut into pieces that overlap by less
    than a window), so what is broadcast is bounded; more items make more automatons, which the
    documents meet one after the other.
    """
    spark = docs.sparkSession
    items = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
        F.col(item_text).alias("text"),
    )
    items = _pieces(items, window)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    found = docs.select(
        F.col(doc_id).alias("key"),
        F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first:int,end:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("item_ids"),
        *carried(carry),
    )
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        rows = [(r["id"], list(words(r["text"].encode()))) for r in block.toLocalIterator()]
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(rows, window))
        found = _scan(found, automaton)
        if k + 1 < blocks:
            found = stored(found, "decontaminate")
            automaton.unpersist()
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    found = found.withColumn("n_hit", hit)
    columns = [
        F.col("key").alias(doc_id),
        F.col("n_words"),
        F.col("n_hit"),
        F.col("spans"),
        F.col("item_ids"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    ]
    if carry:
        columns.append(F.col("row"))
    if longer_than is not None:
        found = _clean(found, longer_than)
        columns.append(F.col("clean_text"))
    return found.select(*columns)


def _clean(found: DataFrame, longer_than: int) -> DataFrame:
    names = found.columns

    def run(batches):
        for batch in batches:
            clean = []
            for text, spans in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                if text and spans:
                    pairs = [[s["first"], s["end"]] for s in spans]
                    text = without_spans(text.encode(), pairs, longer_than).decode()
                clean.append(text)
            columns = [batch.column(n) for n in names]
            yield pa.record_batch([*columns, pa.array(clean, pa.string())], [*names, "clean_text"])

    clean_text = StructField("clean_text", StringType())
    return found.mapInArrow(run, StructType([*found.schema, clean_text]))
