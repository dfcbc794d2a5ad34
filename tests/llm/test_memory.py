import ctypes
import os

import numpy as np
import psutil
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, string_counts, suffix_tree, tables, workers

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_tables_on_the_way_are_written_in_small_parts(spark):
    rows = spark.range(0, 3_000_000, 1, 1).select(F.xxhash64("id").alias("a"))
    kept = tables.stored(rows, "parts")
    file = kept.inputFiles()[0].removeprefix("file://")
    found = pq.ParquetFile(file).metadata
    assert found.num_row_groups > 1
    assert max(found.row_group(k).total_byte_size for k in range(found.num_row_groups)) < 2 * tables.ROW_GROUP
    assert kept.agg(F.count("*"), F.bit_xor("a")).first() == rows.agg(F.count("*"), F.bit_xor("a")).first()


def test_workers_get_few_rows_at_a_time(spark, odd_docs):
    before = spark.conf.get(ROWS)
    for query in (jaccard.near_duplicates, suffix_tree.score_documents):
        spark.conf.set(ROWS, "10000")
        query(odd_docs).collect()
        assert int(spark.conf.get(ROWS)) == tables.BATCH_ROWS
    spark.conf.set(ROWS, before)


def test_a_task_gives_back_what_it_used():
    def run(batches):
        held = [np.ones(3_000) for _ in range(8_000)]  # 190 MB in pieces that the allocator keeps
        keep.append(held[-1])
        yield len(held)

    keep = []
    resident = lambda: psutil.Process(os.getpid()).memory_info().rss
    workers.give_back()
    before = resident()
    assert list(workers.lean(run)([])) == [8_000]
    assert hasattr(ctypes.CDLL(None), "malloc_trim") is False or resident() - before < 60 << 20


def test_what_a_task_gathers_is_bounded():
    parts = [(np.arange(100_000, dtype=np.uint64),)] * 50
    sizes = [len(whole) for whole, in string_counts._gathered(iter(parts), string_counts.TOKENS)]
    assert sum(sizes) == 5_000_000 and max(sizes) <= (1 << 21) + 100_000
