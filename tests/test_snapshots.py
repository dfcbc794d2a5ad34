"""Streams joined with a dimension of which snapshots are added while they go on."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import enrichment, lookups
from ledgerlake.operators.dimensions import customer_accounts
from ledgerlake.plans import tables
from ledgerlake.sinks import changelog, snapshots
from ledgerlake.sources import files
from ledgerlake.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def events(spark):
    return tables.event_transactions(tables.events(spark, SF_DIR))


@pytest.fixture()
def dimension(spark):
    return customer_accounts(tables.accounts(spark, SF_DIR), tables.customers(spark, SF_DIR))


def equal(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def land(rows, place):
    rows.coalesce(1).write.mode("append").json(place, timestampFormat=files.TIMESTAMP_TEXT)


def test_numbers_of_snapshots(spark, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(ValueError):
        snapshots.newest(spark, path)
    for k in range(1, 12):
        assert snapshots.add(spark.range(k), path) == k
    assert snapshots.newest(spark, path) == 11  # as a number, not as a text
    assert snapshots.read(spark, path).count() == 11 and snapshots.read(spark, path, 3).count() == 3
    assert snapshots.prune(spark, path) == list(range(1, 10))
    assert snapshots.read(spark, path, 10).count() == 10
    with pytest.raises(ValueError):
        snapshots.prune(spark, path, keep=0)


def test_a_snapshot_in_writing_is_not_read(spark, tmp_path):
    path = str(tmp_path / "d")
    snapshots.add(spark.range(1), path)

    bad = spark.range(5).select(F.raise_error(F.lit("away")).cast("long").alias("id"))
    with pytest.raises(Exception, match="away"):
        snapshots.add(bad, path)
    assert snapshots.newest(spark, path) == 1
    assert snapshots.add(spark.range(2), path) == 3  # a number is used once


def test_each_micro_batch_takes_the_newest_snapshot(spark, tmp_path, events, dimension):
    """Three snapshots in one run, the third one between two runs; unmatched senders stay."""
    place = str(tmp_path / "json")
    landing, path, log = f"{place}/in", f"{place}/dimension", f"{place}/log"
    parts = [events.where(F.col("transaction_id").cast("int") % 4 == k) for k in range(4)]
    dimensions = [dimension.withColumn("full_name", F.concat("full_name", F.lit(f" {k}"))) for k in (1, 2, 3)]
    for part in parts[:3]:
        land(part, landing)
    snapshots.add(dimensions[0], path)
    write = changelog.batch_writer(log)

    def on_batch(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            snapshots.add(dimensions[1], path)

    def run():
        stream = files.json_stream(spark, landing, max_files_per_trigger=1)
        jobs.enrich(stream, path, on_batch, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW).awaitTermination()

    run()
    snapshots.add(dimensions[2], path)
    land(parts[3], landing)
    run()
    found = changelog.rows(spark, log)
    assert found.columns == [*events.columns, *dimension.columns, jobs.SNAPSHOT]
    for number, part in zip((1, 1, 2, 3), parts, strict=True):
        want = enrichment.enrich_transactions(part, dimensions[number - 1])
        want = want.withColumn(jobs.SNAPSHOT, F.lit(number).cast("long"))
        ids = part.select("transaction_id")
        assert equal(found.join(ids, "transaction_id", "left_semi"), want)
    assert found.where("account_id is null").count() > 0


def test_a_failed_micro_batch_counts_once(spark, tmp_path, events, dimension):
    landing, path, log = (str(tmp_path / n) for n in ("in", "dimension", "log"))
    land(events, landing)
    snapshots.add(dimension, path)
    write, seen = changelog.batch_writer(log), []

    def on_batch(batch, batch_id):
        write(batch, batch_id)
        seen.append(batch_id)
        if len(seen) == 1:
            raise OSError("store is away")

    def run():
        return jobs.enrich(
            files.json_stream(spark, landing), path, on_batch, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW
        )

    with pytest.raises(Exception, match="store is away"):
        run().awaitTermination()
    snapshots.add(dimension.limit(0), path)
    run().awaitTermination()
    found = changelog.rows(spark, log)
    assert seen == [0, 0] and found.count() == events.count()
    assert found.where("account_id is not null").count() == 0  # the snapshot that was newest then


@pytest.mark.parametrize(("limit", "join"), [(lookups.BROADCAST_LIMIT, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_broadcast_only_if_measured_small(spark, tmp_path, events, dimension, limit, join):
    landing, path = str(tmp_path / "in"), str(tmp_path / "dimension")
    land(events, landing)
    twice = dimension.unionByName(dimension.where("account_id % 7 = 0"))
    snapshots.add(twice, path)
    plans, rows = [], []

    def on_batch(batch, batch_id):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        rows.append(batch.count())

    with jobs.set_for(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        jobs.enrich(
            files.json_stream(spark, landing),
            path,
            on_batch,
            str(tmp_path / "checkpoint"),
            jobs.AVAILABLE_NOW,
            broadcast_limit=limit,
        ).awaitTermination()
    assert join in plans[0]
    # An account that occurs twice repeats its transactions, as any left join does.
    assert rows == [enrichment.enrich_transactions(events, twice).count()] and rows[0] > events.count()


def test_a_snapshot_is_measured_once(spark, tmp_path, events, dimension, monkeypatch):
    landing, path = str(tmp_path / "in"), str(tmp_path / "dimension")
    for k in range(3):
        land(events.where(F.col("transaction_id").cast("int") % 3 == k), landing)
    snapshots.add(dimension, path)
    calls = []
    monkeypatch.setattr(jobs, "measured_bytes", lambda df: calls.append(1) or lookups.measured_bytes(df))
    jobs.enrich(
        files.json_stream(spark, landing, max_files_per_trigger=1),
        path,
        lambda batch, batch_id: calls.append(batch.count() * 0),
        str(tmp_path / "checkpoint"),
        jobs.AVAILABLE_NOW,
    ).awaitTermination()
    assert calls == [1, 0, 0, 0]


def test_without_adaptive_execution_a_hot_sender_is_salted(spark, dimension):
    facts = spark.range(2000).select(F.lit("5").alias("sender_account_id"), "id")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with jobs.set_for(spark, settings):
        joined = enrichment.enrich_transactions(facts, dimension, broadcast_limit=0)
        assert joined.where("account_id = 5").count() == 2000
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 2
