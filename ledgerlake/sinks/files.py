"""Parquet tables in shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at `path`. The input must not read from there."""
    df.write.mode("overwrite").parquet(path)


def snapshot(source: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Copy a source table, or the named columns of it, over the last snapshot."""
    overwrite_parquet(source.select(*columns) if columns else source, path)


def write_sized(
    rows: DataFrame, path: str, file_bytes: int = 128 << 20, partition_by: str | None = None
) -> None:
    """Write a table that many small files make up anew, in files of about `file_bytes`.

    The number of files follows from the sizes of those that are read. Rows are dealt evenly, so a
    large day is several files; with `partition_by` each file's rows are ordered by it, so that a
    file holds few days.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for name in rows.inputFiles():
        place = jvm.org.apache.hadoop.fs.Path(name)
        total += place.getFileSystem(conf).getFileStatus(place).getLen()
    count = max(1, -(-total // file_bytes))
    if partition_by is None:
        rows.repartition(count).write.parquet(path)
    else:
        ranged = rows.repartitionByRange(count, partition_by, F.xxhash64(*rows.columns))
        ranged.write.partitionBy(partition_by).parquet(path)
