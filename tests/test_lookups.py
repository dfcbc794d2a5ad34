from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.lookups import left_lookup, measured_bytes, salt


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def facts(spark):
    # A third of the rows has one key, some have none, and some match nothing.
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 10 == 1, None)
        .otherwise((F.col("id") % 150).cast("int"))
    )
    return spark.range(3000).select(F.col("id").alias("n"), key.alias("k"))


@pytest.fixture()
def dimension(spark):
    # Key 5 occurs twice: its facts come back twice.
    ids = spark.range(100).select(F.col("id").cast("int").alias("d"))
    ids = ids.unionAll(spark.sql("select 5 as d"))
    return ids.withColumn("name", F.concat(F.lit("name "), "d"))


def brute_force(facts, dimension):
    names = {}
    for row in dimension.collect():
        names.setdefault(row["d"], []).append(row["name"])
    rows = Counter()
    for row in facts.collect():
        for name in names.get(row["k"], [None]):
            rows[row["n"], row["k"], name] += 1
    return rows


def found(df):
    return Counter((row["n"], row["k"], row["name"]) for row in df.collect())


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1, None), (None, 2, True)], "s string, i int, b boolean")
    assert measured_bytes(df) == 2 * 3 * 16 + 3
    assert measured_bytes(df.limit(0)) == 0
    with pytest.raises(TypeError):
        measured_bytes(df.select(F.array("i").alias("a")))


def test_small_dimension_is_broadcast(facts, dimension):
    joined = left_lookup(facts, dimension, F.col("k"), "d")
    assert "BroadcastHashJoin" in plan(joined)
    assert found(joined) == brute_force(facts, dimension)


def test_large_dimension_is_not_broadcast(spark, facts, dimension):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_lookup(facts, dimension, F.col("k"), "d", broadcast_limit=100)
        assert "SortMergeJoin" in plan(joined) and "Broadcast" not in plan(joined)
        assert found(joined) == brute_force(facts, dimension)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_key_is_split_in_batch(spark, facts, dimension):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100",
        "spark.sql.shuffle.partitions": "50",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        spread = facts.repartition(8)
        joined = left_lookup(spread, dimension, F.col("k"), "d", broadcast_limit=0)
        assert found(joined) == brute_force(facts, dimension)
        assert "skew=true" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("broadcast_limit", [0, 10**9])
def test_hot_key_in_a_stream(spark, tmp_path, facts, dimension, broadcast_limit):
    facts.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(facts.schema).parquet(str(tmp_path / "in"))
    joined = left_lookup(stream, dimension, F.col("k"), "d", broadcast_limit, salt_buckets=5)
    assert joined.columns == ["n", "k", "d", "name"]
    out = str(tmp_path / "out")
    query = joined.writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    )
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert found(spark.read.parquet(out)) == brute_force(facts, dimension)


def test_copies_of_a_row_are_spread(spark):
    copies = spark.range(0, 4000, 1, 40).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    buckets = copies.withColumn("salt", salt(copies, 8)).groupBy("salt").count().collect()
    assert {row["salt"] for row in buckets} == set(range(8))
    assert max(row["count"] for row in buckets) < 1500
    distinct = spark.range(0, 4000, 1, 1).select(F.lit(7).alias("k"), "id")
    buckets = distinct.withColumn("salt", salt(distinct, 8)).groupBy("salt").count().collect()
    assert max(row["count"] for row in buckets) < 700
