"""Snapshots of a table side by side: who reads one keeps it while the next is written.

    <path>/versions/N   the rows of snapshot N = 1, 2, ...
    <path>/claims/N     empty; someone writes, or has written, snapshot N
    <path>/finished/N   empty; snapshot N can be read
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sinks.folders import Folder, numbers


def add(rows: DataFrame, path: str) -> int:
    """Write a further snapshot; returns its number. Until it is finished, readers see the last one."""
    spark = rows.sparkSession
    last = max(numbers(spark, f"{path}/claims"), default=0)
    version = Folder(spark, f"{path}/claims").claim_next(start=last + 1)
    rows.write.mode("overwrite").parquet(f"{path}/versions/{version}")
    Folder(spark, f"{path}/finished").touch(str(version))
    return version


def newest(spark: SparkSession, path: str) -> int:
    """The number of the newest finished snapshot."""
    found = numbers(spark, f"{path}/finished")
    if not found:
        raise ValueError(f"{path} holds no finished snapshot")
    return found[-1]


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A snapshot, by default the newest one."""
    return spark.read.parquet(f"{path}/versions/{newest(spark, path) if version is None else version}")


def prune(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all finished snapshots but the newest `keep`; returns their numbers.

    A micro-batch that reads an older one is run again with the newest. Claims stay, so that no
    number comes twice.
    """
    if keep < 1:
        raise ValueError("the newest snapshot has to stay")
    gone = numbers(spark, f"{path}/finished")[:-keep]
    for version in gone:
        Folder(spark, f"{path}/finished").remove(str(version))
        Folder(spark, f"{path}/versions").remove(str(version))
    return gone
