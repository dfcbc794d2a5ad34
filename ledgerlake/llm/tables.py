"""Reading the given tables, and tables written on the way."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans.workspace import new_place

#: Bytes that the writer of a table holds before they go to the file; the default is 128 MB for each task.
ROW_GROUP = 8 << 20
#: Rows that a Python worker gets at a time; the default is 10,000.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(columns: Sequence[str]) -> list[Column]:
    """The columns as one struct named row, if there are any."""
    return [F.struct(*columns).alias("row")] if columns else []


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: later steps don't compute it anew."""
    spark = df.sparkSession
    place = new_place(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def few_rows_at_once(spark: SparkSession) -> None:
    """From now on Python workers of the session get few rows at a time, so that neither they nor the
    executors beside them hold many whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of `stored` that no later step reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps left behind.

    Spark removes the shuffle files of a step when the driver's collector finds it unused, which
    by default may be half an hour later; long chains of steps would fill the disks until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
