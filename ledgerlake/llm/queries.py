"""The operators over the given tables, and their SQL for a second engine where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bottom_k,
    bpe,
    conversations,
    decontamination,
    jaccard,
    merkle,
    sharding,
    style_tree,
    suffix_dedup,
    suffix_tree,
    toxicity,
    warc,
    winnowing,
)
from ledgerlake.llm.conversations_sql import conversations_sql
from ledgerlake.llm.merkle_sql import merkle_sql
from ledgerlake.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnowing.with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.col("next_text"), half))
    found = rows.withColumn("edited", edited).select(
        F.col("key").alias("doc_id"),
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.winnow(F.col("text")).alias("own"),
        winnowing.winnow(F.col("edited")).alias("changed"),
        winnowing.winnow(F.col("next_text")).alias("next"),
    )
    found = found.select(
        "*", *[winnowing.hashes(F.col(c)).alias(f"{c}_set") for c in ("own", "changed", "next")]
    )
    as_text = lambda c: F.array_join(F.transform(c, lambda v: F.hex(v)), " ")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("changed").alias("edited_fingerprint"),
        winnowing.likeness(F.col("own_set"), F.col("changed_set")).alias("near_edited"),
        winnowing.likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(TOKENIZER))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op5_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = style_tree.extract_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(warc.archive_pages(pages)).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, tagger).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op11_turn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    edits = conversations.repaired(conversations.damage(given), known=given.select("conv_id"))
    return conversations.digests(edits)


def op12_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    longer = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    docs = docs.withColumn("changed", F.when(tampered, merkle.leaf_digest(longer)))
    found = merkle.manifest(docs, carry=["changed"])
    folded = merkle.fold(F.coalesce("row.changed", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Query]:
    found = [
        op1_winnowing,
        op2_jaccard,
        op3_bpe,
        op4_sharding,
        op5_style_tree,
        op6_warc,
        op7_suffix_dedup,
        op8_decontamination,
        op9_suffix_tree,
        op10_toxicity,
        op11_turn_blocks,
        op12_bottom_k,
        op13_merkle,
    ]
    return {f.__name__: f for f in found}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


def _sharding_sql() -> str:
    names = ", ".join(f"'{name}'" for name in sharding.SHARDS)
    number = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    return f"""
WITH RECURSIVE shard AS (
  SELECT [{names}] AS names, {len(sharding.SHARDS)} AS n, {sharding.SLOTS} AS m
), taste AS (
  SELECT *, list_transform(names, lambda x: {number.format("'offset:' || x")} % m) AS first,
         list_transform(names, lambda x: {number.format("'skip:' || x")} % (m - 1) + 1) AS skip
  FROM shard
), fill AS (
  SELECT 0 AS turn, list_transform(range(m), lambda x: -1) AS owner FROM shard
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(owner[1:free], [turn % n]), owner[free + 2:])
  FROM (
    SELECT turn, owner, n,
           list_filter(list_transform(range(m), lambda r: (first[turn % n + 1] + r * skip[turn % n + 1]) % m),
                       lambda s: owner[s + 1] < 0)[1] AS free
    FROM fill, taste WHERE turn < m
  )
), full_table AS (SELECT owner FROM fill, shard WHERE turn = m)
SELECT doc_id, slot::INTEGER AS slot, names[owner[slot + 1] + 1] AS shard
FROM (SELECT doc_id, {number.format("coalesce(doc_id::VARCHAR, '')")} % {sharding.SLOTS} AS slot FROM documents),
     full_table, shard
"""


def _decontamination_sql() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words.format(_folded("text"))} AS w FROM documents),
i AS (SELECT item_id, {words.format(_folded("text"))} AS w FROM benchmark),
piece AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM (SELECT *, least(len(w), 13) AS k FROM i WHERE len(w) > 0))
),
hit AS (
  SELECT doc_id, s, k, win
  FROM (SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
              FROM d, (SELECT DISTINCT k FROM piece) WHERE len(w) >= k))
  WHERE win IN (SELECT win FROM piece)
),
word AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY 1),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit JOIN piece USING (win)) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(word.n, 0)::BIGINT AS n_hit,
       coalesce(item.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""


_WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS digest,
         strlen(coalesce(html, '')) AS bytes FROM pages
), f AS (SELECT digest, min(page_id) AS first FROM p WHERE bytes >= 100 GROUP BY 1)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""


def _jaccard_sql(words: int, num: int, more: str = "") -> str:
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_folded("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + {words - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, least(len(w), 1)) + 1)) AS p FROM d)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), link AS (
  SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= {num} * (x.n + y.n - o)
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id{more}
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON a = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard": _jaccard_sql(5, 80),
        "op4_sharding": _sharding_sql(),
        "op6_warc": _WARC_SQL,
        "op8_decontamination": _decontamination_sql(),
        "op11_turn_blocks": conversations_sql(),
        "op12_bottom_k": _jaccard_sql(3, 85, ", d.doc_id <= coalesce(m, d.doc_id) AS kept"),
        "op13_merkle": merkle_sql(),
    }
