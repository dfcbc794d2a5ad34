"""Compaction of the table that a stream appends to, while it goes on.

A micro-batch leaves a file for each of its partitions. A compaction gathers the files that no one
before has gathered into few large ones, beside the lake, and then tells which files those stand
for; readers take the gathered parts, and of the lake the files that none of them stands for.

    <place>/parts/N      the rows of compaction N = 1, 2, ...
    <place>/covers/N     the names of the lake's files that it stands for
    <place>/claims/N     empty; compaction N has begun
    <place>/finished/N   empty; compaction N counts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sinks.files import write_sized
from ledgerlake.sinks.folders import Folder, numbers
from ledgerlake.sources.files import read_parquet

FILE_BYTES = 128 << 20


def _covered(spark: SparkSession, place: str, parts: list[int]) -> set[str]:
    """Names of files: as many as the driver lists for the lake itself."""
    folders = [f"{place}/covers/{number}" for number in parts]
    return {row["value"] for row in spark.read.text(folders).collect()} if folders else set()


def _fresh(spark: SparkSession, lake: str, place: str, parts: list[int]) -> list[str]:
    """The committed files of the lake that no part stands for."""
    return sorted(set(read_parquet(spark, lake).inputFiles()) - _covered(spark, place, parts))


def _files(spark: SparkSession, lake: str, names: list[str]) -> DataFrame:
    schema = read_parquet(spark, lake).schema
    return spark.read.schema(schema).option("basePath", lake).parquet(*names)


def read(spark: SparkSession, lake: str, place: str) -> DataFrame:
    """Every committed row of the lake once, before, while and after it is compacted.

    What counts is settled when this is called: a compaction that finishes later changes nothing.
    """
    parts = numbers(spark, f"{place}/finished")
    whole = read_parquet(spark, lake)
    if not parts:
        return whole
    folders = [f"{place}/parts/{number}" for number in parts]
    found = [spark.read.schema(whole.schema).parquet(folder) for folder in folders]
    fresh = _fresh(spark, lake, place, parts)
    if fresh:
        found.append(_files(spark, lake, fresh))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.select(*whole.columns)


def compact(
    spark: SparkSession,
    lake: str,
    place: str,
    file_bytes: int = FILE_BYTES,
    partition_by: str | None = None,
) -> int | None:
    """Gather what has been added since the last compaction; None if that is nothing.

    Each file is gathered once, so a compaction costs what was added. One compaction of a lake runs
    at a time; one that broke off is made again by the next under a new number, and what it left is
    never read.
    """
    parts = numbers(spark, f"{place}/finished")
    fresh = _fresh(spark, lake, place, parts)
    if not fresh:
        return None
    number = Folder(spark, f"{place}/claims").claim_next(start=max(parts, default=0) + 1)
    write_sized(_files(spark, lake, fresh), f"{place}/parts/{number}", file_bytes, partition_by)
    names = spark.createDataFrame([(name,) for name in fresh], "value string")
    names.coalesce(1).write.text(f"{place}/covers/{number}")
    # Not finished by another one meanwhile: else its files would be told twice.
    if numbers(spark, f"{place}/finished") != parts:
        raise RuntimeError(f"another compaction of {lake} finished meanwhile; this one is left out")
    Folder(spark, f"{place}/finished").touch(str(number))
    return number
