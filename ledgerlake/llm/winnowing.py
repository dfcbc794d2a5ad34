"""Document fingerprints by winnowing, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tokens: what stands between white space, if it has at most so many characters. Of longer runs, as in
#: texts without white space, each character is one, so grams are found again wherever a run begins.
LONGEST_WORD = 24
_TOKEN = rf"(?<!\S)\S{{1,{LONGEST_WORD}}}+(?!\S)|\S"
#: Tokens of a gram, and grams of a window. Runs of GRAM + WINDOW - 1 equal tokens share a fingerprint.
GRAM, WINDOW = 3, 4
#: Bits of a fingerprint that hold its place; the others hold its hash.
PLACE_BITS = 22
_PLACES = (1 << PLACE_BITS) - 1
_HASHES = (1 << 63) - 1 - _PLACES


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The fingerprints of a text: of each window of consecutive grams the one of smallest hash, the
    rightmost of equal ones; ascending by place, each once.

    A fingerprint is a long: the hash of the gram in its high bits and, in its low bits, counted
    down, the gram's place (the number of its first token, from 0), so that the smallest long of a
    window is what winnowing takes. Tokens are compared in lower case. A text of fewer than
    `gram` tokens has one gram of all of them, one of fewer grams than a window one window; null and
    empty texts and those of white space have no fingerprint. (Places begin anew after 2 ** 22.)
    """
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TOKEN), F.lit(0))

    def grams(t: Column) -> Column:
        def at(i: Column) -> Column:
            hashed = F.xxhash64(*[F.get(t, i + j) for j in range(gram)])
            place = F.lit(_PLACES) - i.bitwiseAND(F.lit(_PLACES))
            return hashed.bitwiseAND(F.lit(_HASHES)).bitwiseOR(place)

        last = F.greatest(F.size(t) - gram, F.lit(0))
        all_of = F.transform(F.sequence(F.lit(0), last), at)
        return F.when(F.size(t) > 0, all_of).otherwise(F.array().cast("array<bigint>"))

    def chosen(g: Column) -> Column:
        last = F.greatest(F.size(g) - window + 1, F.lit(1))
        smallest = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_min(F.slice(g, i, window)))
        return F.when(F.size(g) > 0, F.array_distinct(smallest)).otherwise(g)

    hashes = F.transform(tokens, lambda token: F.xxhash64(token))
    return _once(_once(hashes, grams), chosen)


def hashes(fingerprint: Column) -> Column:
    """The distinct hashes of a fingerprint, without places."""
    return F.array_distinct(F.transform(fingerprint, lambda v: F.shiftright(v, PLACE_BITS)))


def places(fingerprint: Column) -> Column:
    """The places of a fingerprint's grams: numbers of their first tokens."""
    return F.transform(fingerprint, lambda v: F.lit(_PLACES) - v.bitwiseAND(F.lit(_PLACES)))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of distinct hashes, the share that both have; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(1.0))


def fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """`doc_id` and fingerprint (array of place int, hash long) of every row's whole text.

    See `winnow`; repeated rows and equal texts have equal fingerprints; nothing is shuffled; other
    columns are not read.
    """
    found = winnow(F.col(text).cast("string"), gram, window)
    pair = lambda v: F.struct(
        (F.lit(_PLACES) - v.bitwiseAND(F.lit(_PLACES))).cast("int").alias("place"),
        F.shiftright(v, PLACE_BITS).alias("hash"),
    )
    rows = docs.select(F.col(doc_id), found.alias("fingerprint"))
    return rows.withColumn("fingerprint", F.transform("fingerprint", pair))


def _bounds(spark: SparkSession, keys: DataFrame) -> list[int]:
    """Keys that cut the rows into even ranges, about four for each partition of a shuffle."""
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    cut = F.percentile_approx("key", shares, max(10_000, 10 * ranges))
    return sorted(set(keys.agg(cut).first()[0] or []))


def _range(bounds: list[int]) -> Column:
    """The number of a key's range: 0 for a null key, else 1 + the bounds below it, found in two steps."""
    if not bounds:
        return F.when(F.col("key").isNull(), F.lit(0)).otherwise(F.lit(1))
    width = math.isqrt(len(bounds)) + 1
    parts = [bounds[k : k + width] for k in range(0, len(bounds), width)]
    below = lambda values: F.size(F.filter(values, lambda b: b < F.col("key")))
    part = F.greatest(below(F.lit([p[0] for p in parts])) - 1, F.lit(0))
    place = part * width + below(F.get(F.lit(parts), part)) + 1
    return F.when(F.col("key").isNull(), F.lit(0)).otherwise(place)


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text (null as empty) and next_text: the text of the row that follows when rows are in
    descending order of their id, nulls last, of equal ids by their text; the last is followed by
    the first. Ids are whole numbers.

    Rows are dealt by ranges of ids with about equally many rows, each ordered for itself. The first
    row of a range is sent to the range before it too, so no task sees more than a range.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    place = _range(_bounds(spark, rows.select("key")))
    heads = rows.select("key", place.alias("range")).groupBy("range").agg(F.max("key").alias("head"))
    heads = sorted(heads.collect(), reverse=True)  # one row for each range
    if not heads:
        return rows.withColumn("next_text", F.col("text"))
    known = {r["range"]: r["head"] for r in heads}
    # The ranges in the rows' order: the head of each also follows the range before it.
    before = {r["range"]: heads[k - 1]["range"] for k, r in enumerate(heads)}
    last = max(known)
    head = F.get(F.lit([known.get(k) if known.get(k) is not None else 0 for k in range(last + 1)]), F.col("range"))
    guest = F.get(F.lit([before.get(k, 0) for k in range(last + 1)]), F.col("range"))
    is_head = F.col("key").isNull() | (F.col("key") == head)
    own = F.struct(F.col("range"), F.lit(0).alias("guest"))
    also = F.struct(guest.alias("range"), F.lit(1).alias("guest"))
    dealt = rows.withColumn("range", place).select(
        "key", "text", F.inline(F.when(is_head, F.array(own, also)).otherwise(F.array(own)))
    )
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc_nulls_last(), "text")
    return (
        dealt.withColumn("next_text", F.lead("text").over(order))
        .where("guest = 0")
        .select("key", "text", "next_text")
    )
