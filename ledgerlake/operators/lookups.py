"""Left joins of a large fact table with a dimension, at any size and skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when its measured size is at most this many bytes.
BROADCAST_LIMIT = 64 * 1024 * 1024

# Copies of the dimension in a salted join: one hot key is spread over this many tasks.
SALT_BUCKETS = 16

# Tasks that rows without a key are dealt to.
NULL_BUCKETS = 1 << 16

_SALT = "_salt"


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of `df`, measured by one distributed aggregation (one row comes back)."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        if isinstance(field.dataType, T.AtomicType):
            return F.lit(16)
        raise TypeError(f"cannot measure column {field.name} of type {field.dataType.simpleString()}")

    row = F.lit(0).cast("long")
    for field in df.schema.fields:
        row = row + width(field)
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def salt(facts: DataFrame, buckets: int) -> Column:
    """A bucket from a row's values and its partition: the same whenever a task is run again.

    Rows with one key differ in their values; copies of one row differ in their partition.
    """
    values = F.xxhash64(*facts.columns, F.spark_partition_id())
    return F.pmod(values, F.lit(buckets)).cast("int")


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: Column,
    dimension_key: str,
    broadcast_limit: int | None = BROADCAST_LIMIT,
    salt_buckets: int = SALT_BUCKETS,
    known_bytes: int | None = None,
) -> DataFrame:
    """`facts` left joined with `dimension`; facts without a match keep null columns.

    - A dimension measured within `broadcast_limit` is broadcast: the facts do not move.
      `broadcast_limit=None` skips the measurement and leaves the choice to the planner's
      own threshold, which suits facts that are small themselves. `known_bytes` is a
      measurement that the caller has already made.
    - A larger one is joined by shuffle. For batch input, adaptive execution splits the
      partition of a hot key. It does not run for stateful streams and their micro-batches,
      so there each fact gets a salt and the dimension is repeated per salt.
    """
    key = F.col(dimension_key)
    if broadcast_limit is not None:
        size = measured_bytes(dimension) if known_bytes is None else known_bytes
        if size <= broadcast_limit:
            return facts.join(F.broadcast(dimension), fact_key == key, "left")
    adaptive = facts.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if adaptive and not facts.isStreaming:
        # Rows without a key match nothing: dealt by a second, made-up key, they do not meet in
        # one task.
        spread = F.when(fact_key.isNull(), salt(facts, NULL_BUCKETS)).otherwise(0)
        left = facts.withColumn(_SALT, spread)
        right = dimension.withColumn(_SALT + "_copy", F.lit(0))
        same = (fact_key == key) & (F.col(_SALT) == F.col(_SALT + "_copy"))
        return left.join(right, same, "left").drop(_SALT, _SALT + "_copy")

    salts = F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
    left = facts.withColumn(_SALT, salt(facts, salt_buckets))
    right = dimension.select("*", salts.alias(_SALT + "_copy"))
    joined = left.join(right, (fact_key == key) & (F.col(_SALT) == F.col(_SALT + "_copy")), "left")
    return joined.drop(_SALT, _SALT + "_copy")
