"""The documents on their way to training data, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; what it returns
is written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontamination, jaccard, suffix_dedup, toxicity
from ledgerlake.llm.tables import few_rows_at_once, stored, table
from ledgerlake.operators.lookups import BROADCAST_LIMIT, measured_bytes

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents of this score and more are rejected.
TOXIC = 0.7


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows with a number of their own, so that Python needs to hand back only numbers.

    Whole rows stay in the JVM, and Python gets few rows at a time.
    """
    few_rows_at_once(spark)
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "pipeline-rows")


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose number is not among the rejected ones, which are broadcast if they are few."""
    rejected = stored(rejected.select("_row"), "pipeline-rejected")
    if measured_bytes(rejected) <= BROADCAST_LIMIT:
        rejected = F.broadcast(rejected)
    return rows.join(rejected, "_row", "left_anti").select(*COLUMNS)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger, learned from the labelled ones among them, does not reject."""
    rows = _numbered(spark, docs)
    tagger = toxicity.learn(rows, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(rows, tagger, doc_id="_row")
    return _without(rows, scored.where(F.col("score") >= TOXIC))


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id, of equal or no ids the first row."""
    rows = _numbered(spark, docs)
    found = jaccard.near_duplicates(rows, doc_id="_row").select("_row", "component_id")
    found = stored(found.join(rows.select("_row", "doc_id"), "_row"), "pipeline-components")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    kept = found.groupBy("component_id").agg(first.alias("first")).select(F.col("first._row").alias("_row"))
    return _without(rows, found.select("_row").join(kept, "_row", "left_anti"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes and more that occur again among them."""
    few_rows_at_once(spark)
    docs = docs.withColumn("_has_text", F.col("text").isNotNull())
    found = suffix_dedup.remove_repeats(docs, carry=("lang", "source", "n_chars", "_has_text"), as_text=True)
    return found.select(
        "doc_id",
        F.when(F.col("row._has_text"), F.col("kept")).alias("text"),
        "row.lang",
        "row.source",
        F.when(F.size("spans") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"),
    )


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in benchmark items."""
    rows = _numbered(spark, docs)
    found = decontamination.decontaminate(rows, table(spark, sf_dir, "benchmark"), doc_id="_row")
    return _without(rows, found.where("contaminated"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids: the whole texts as tokens."""
    few_rows_at_once(spark)
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(docs, vocabulary).select("doc_id", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", harmless),
    ("near duplicates", apart),
    ("repeated passages", unrepeated),
    ("benchmark decontamination", uncontaminated),
    ("encoding", encoded),
]

#: A learned tagger, bytes of any offset and merges of a vocabulary are beyond SQL; the tests hold the
#: stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
