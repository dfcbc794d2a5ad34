"""A keyed table kept as a log of changes, for streams that update their results.

Each micro-batch writes its changed rows to a new directory and then sets a mark; only marked
directories are read, so a batch that is being written, or written again, shows nothing of it. Of a
batch that was run twice the last attempt that was finished counts; attempts are numbered by who
could claim a number first, not by a clock. Reading takes each key's last row.
One log belongs to one streaming query: batch ids must not start over.

    <path>/changes/batch_id=N/attempt=A   changed rows of micro-batch N, of its attempt A = 0, 1, ...
    <path>/claims/N.A                     empty; attempt A of micro-batch N has begun
    <path>/marks/N.A                      empty; attempt A of micro-batch N was finished
    <path>/base/upto=N                    each key's last row as of micro-batch N
    <path>/bases/N                        empty; this base is finished
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.sinks.folders import Folder, numbers

def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that logs each micro-batch. Errors are raised."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        attempt = Folder(spark, f"{path}/claims").claim_next(f"{batch_id}.")
        batch.write.parquet(f"{path}/changes/batch_id={batch_id}/attempt={attempt}")
        Folder(spark, f"{path}/marks").touch(f"{batch_id}.{attempt}")

    return write


def _finished_base(spark: SparkSession, path: str) -> int | None:
    return max(numbers(spark, f"{path}/bases"), default=None)


def _finished_batches(spark: SparkSession, path: str) -> dict[int, int]:
    """The attempt that counts of each finished micro-batch: the one that began last."""
    marks = (name.split(".") for name in Folder(spark, f"{path}/marks").names())
    return dict(sorted((int(batch_id), int(attempt)) for batch_id, attempt in marks))


def _log(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    last: int | None = None,
) -> DataFrame:
    upto = _finished_base(spark, path)
    changes = [
        f"{path}/changes/batch_id={batch_id}/attempt={attempt}"
        for batch_id, attempt in _finished_batches(spark, path).items()
        if (upto is None or batch_id > upto) and (last is None or batch_id <= last)
    ]
    reader = spark.read if schema is None else spark.read.schema(schema)
    parts = []
    if changes:
        # The ids of the batches are told by the paths.
        newer = reader.option("basePath", f"{path}/changes").parquet(*changes)
        parts.append(newer.drop("attempt").withColumn("batch_id", F.col("batch_id").cast("long")))
    if upto is not None:
        base = spark.read.parquet(f"{path}/base/upto={upto}")
        parts.append(base.withColumn("batch_id", F.lit(upto).cast("long")))
    if not parts:
        if schema is None:
            raise ValueError(f"{path} holds no finished batch; its columns are not known")
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("long"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _last_rows(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A key has one row per batch at most: no group is large, and all values are of one row.
    # Taken one by one, numbers are aggregated by hash; a struct or a text would be by sorting.
    values = [name for name in log.columns if name not in (*keys, "batch_id")]
    last = [F.max_by(name, "batch_id").alias(name) for name in values]
    return log.groupBy(*keys).agg(*last)


def latest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: StructType | str | None = None,
) -> DataFrame:
    """Each key's last row as of the finished batches. With `schema`, a log without any is empty."""
    return _last_rows(_log(spark, path, schema), keys)


def rows(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """All rows of the finished batches, of a log that is only appended to and not compacted."""
    return _log(spark, path, schema).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int | None:
    """Gather the log into a new base, so that reading need not go back to the first batch.

    The stream may go on meanwhile. Its newest batch may be written again after a restart, so the
    base covers the batches before it; and it counts only once it is marked as finished. Change
    directories up to the returned batch id are not read any more; `prune` removes them. None means
    that there is nothing to gather yet.
    """
    newest = sorted(_finished_batches(spark, path))[-2:]
    base = _finished_base(spark, path)
    if len(newest) < 2 or (base is not None and newest[0] <= base):
        return base
    upto = newest[0]
    gathered = _last_rows(_log(spark, path, last=upto), keys)
    gathered.write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
    Folder(spark, f"{path}/bases").touch(str(upto))
    return upto


def prune(spark: SparkSession, path: str) -> int | None:
    """Remove what the newest base has made superfluous; returns its batch id, None without a base.

    To be run when no reader still uses an older state. Marks go last, so that a removal which is
    broken off can be repeated.
    """
    upto = _finished_base(spark, path)
    if upto is None:
        return None
    for name, number in (("changes", "batch_id="), ("base", "upto=")):
        folder = Folder(spark, f"{path}/{name}")
        for entry in folder.names():
            found = int(entry.removeprefix(number))
            if found < upto or (found == upto and name == "changes"):
                folder.remove(entry)
    bases = Folder(spark, f"{path}/bases")
    for entry in bases.names():
        if int(entry) < upto:
            bases.remove(entry)
    for kind in ("claims", "marks"):
        folder = Folder(spark, f"{path}/{kind}")
        for entry in folder.names():
            if int(entry.split(".")[0]) <= upto:
                folder.remove(entry)
    return upto
