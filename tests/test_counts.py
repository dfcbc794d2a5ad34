"""What was read, kept and rejected; rates; state; streams that go on."""

import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake.operators import insights, messages
from ledgerlake.operators.messages import to_messages
from ledgerlake.operators.pivots import pivot, pivot_labels
from ledgerlake.plans import queries, tables
from ledgerlake.plans.replay import time_ranges
from ledgerlake.sinks import changelog
from ledgerlake.sources import files
from ledgerlake.streaming import jobs, progress, state

SF_DIR = "/root/testdata/sf0.001"

BAD = [
    (None, "unreadable"),
    (b"", "unreadable"),
    (b"not json", "unreadable"),
    (b"{}", "unreadable"),
    (b'{"other":1}', "unreadable"),
    (b'{"amount":5}', "no transaction_id"),
    (b'{"transaction_id":"7","timestamp":"soon","transaction_type":"a"}', "no timestamp"),
    (b'{"transaction_id":"8","timestamp":"2024-01-01T00:00:00"}', "no transaction_type"),
    (b'{"transaction_id":"9","timestamp":"2024-01-01T00:00:00","transaction_type":"a"}', None),
    (b'{"transaction_id":"9","timestamp":"2024-01-01T00:00:00","transaction_type":"a","amount":"much"}', None),
]


@pytest.fixture(scope="module")
def events(spark):
    return tables.event_transactions(tables.events(spark, SF_DIR))


@pytest.fixture(scope="module")
def flawed(spark, events):
    found = spark.createDataFrame([(value,) for value, _ in BAD], "value binary")
    return found.unionByName(to_messages(events)).repartition(4)


def test_reasons(spark):
    found = spark.createDataFrame(BAD, "value binary, reason string")
    got = messages.rejected_messages(found.select("value")).collect()
    want = [r for r in found.collect() if r.reason]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
    parsed = messages.parse_messages(found.select("value"))
    assert messages.rejected_rows(parsed).count() == len(want)


def test_a_batch_counts_as_it_stores(spark, tmp_path, events, flawed):
    seen = Observation()
    parsed = messages.counted(messages.parse_messages(flawed), seen)
    messages.lake_rows(parsed).write.parquet(str(tmp_path / "lake"))
    counts = seen.get
    assert counts["read"] == events.count() + len(BAD) == counts["kept"] + counts["rejected"]
    assert counts["kept"] == spark.read.parquet(str(tmp_path / "lake")).count()
    assert counts["rejected"] == 8 == counts["unreadable"] + sum(v for k, v in counts.items() if k.startswith("no "))
    assert [counts[f"no {c}"] for c in messages.LAKE_REQUIRED] == [1, 1, 1]


def test_nothing_to_count(spark, tmp_path):
    seen = Observation()
    nothing = spark.createDataFrame([], "value binary")
    messages.counted(messages.parse_messages(nothing), seen).write.parquet(str(tmp_path / "lake"))
    assert set(seen.get.values()) == {0}


def test_a_stream_counts_in_its_progress(spark, tmp_path, events, flawed):
    landing, lake, aside = (str(tmp_path / n) for n in ("in", "lake", "aside"))
    flawed.write.parquet(landing)
    stream = files.message_stream(spark, landing, max_files_per_trigger=1)
    query = jobs.ingest(stream, lake, str(tmp_path / "c1"), jobs.AVAILABLE_NOW)
    query.awaitTermination()
    found = progress.batches(query, jobs.MESSAGES)
    assert [b.number for b in found] == [0, 1, 2, 3]
    assert all(b.counts["read"] == b.rows == b.counts["kept"] + b.counts["rejected"] for b in found)
    assert progress.totals(found)["kept"] == files.read_parquet(spark, lake).count() == events.count() + 2
    again = jobs.ingest(stream, lake, str(tmp_path / "c1"), jobs.AVAILABLE_NOW)
    again.awaitTermination()
    assert progress.batches(again, jobs.MESSAGES) == []

    jobs.set_aside(stream, aside, str(tmp_path / "c2"), jobs.AVAILABLE_NOW).awaitTermination()
    rejected = files.read_parquet(spark, aside).groupBy("reason").count().collect()
    totals = progress.totals(found)
    assert {r["reason"]: r["count"] for r in rejected} == {
        k: n for k, n in totals.items() if n and (k.startswith("no ") or k == "unreadable")
    }


def test_rate_limit_of_the_registered_stream(spark):
    _, batches = queries._ingest_limited(spark, SF_DIR)
    assert len(batches) >= 3
    unlimited = queries.ingest_transactions(spark, SF_DIR).count()
    assert sum(b.rows for b in batches) == unlimited


def test_state_is_evicted_with_its_days(spark, tmp_path):
    """The rows of the state, read from the checkpoint, before and after days close."""
    rows = tables.events(spark, SF_DIR)
    parts = [tables.event_transactions(rows.where(p)) for p in time_ranges(rows, "ts", 4)]

    def sizes(name, lateness):
        landing, found = str(tmp_path / f"in-{name}"), []
        for part in parts:
            to_messages(part).write.mode("append").parquet(landing)
            jobs.watch_fraud(
                files.message_stream(spark, landing),
                changelog.batch_writer(str(tmp_path / name)),
                str(tmp_path / f"c-{name}"),
                jobs.AVAILABLE_NOW,
                lateness,
            ).awaitTermination()
            found.append(state.stored_state(spark, str(tmp_path / f"c-{name}")).count())
        return found

    kept, bounded = sizes("kept", jobs.KEEP_ALL), sizes("bounded", "1 day")
    assert kept == sorted(kept) and kept[-1] > 3 * kept[0] / 2
    assert max(bounded) < kept[-1] / 4 and bounded[-1] < 2 * bounded[0]
    days = state.open_days(spark, str(tmp_path / "c-bounded"))
    assert days.count() == bounded[-1]
    # What is still open is what the log told last of these days.
    log = changelog.latest(spark, str(tmp_path / "bounded"), ["sender_account_id", "transaction_date"])
    assert days.exceptAll(log.select(*days.columns)).isEmpty()


def test_a_drained_stream_has_taken_everything(spark, tmp_path, events):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    to_messages(events).write.parquet(landing)
    stream = files.message_stream(spark, landing)
    query = jobs.ingest(stream, lake, str(tmp_path / "checkpoint"), {"processingTime": "200 milliseconds"})
    query.processAllAvailable()
    first = query.lastProgress.batchId
    time.sleep(1.5)  # triggers without messages make no micro-batch
    assert query.isActive and query.lastProgress.batchId in (first, first + 1)
    to_messages(events).write.mode("append").parquet(landing)
    jobs.drain(query)
    assert not query.isActive
    assert files.read_parquet(spark, lake).count() == 2 * events.count()


def test_labels_are_bounded_by_default(spark, events):
    rows = spark.range(50).select(F.lit(1).alias("g"), F.col("id").alias("label"))
    with jobs.set_for(spark, {"spark.sql.pivotMaxValues": "49"}):
        with pytest.raises(ValueError, match="more than 49 values"):
            pivot_labels(rows, "label")
        with pytest.raises(ValueError, match="more than 49 values"):
            pivot(rows, F.col("g"), "label", F.count("g"))
        with pytest.raises(ValueError, match="transaction_type has more than 49"):
            insights.monthly_type(events.withColumn("transaction_type", F.col("transaction_id")))
        assert len(pivot_labels(rows, "label", at_most=50)) == 50
    with jobs.set_for(spark, {"spark.sql.pivotMaxValues": "50"}):
        assert len(pivot(rows, F.col("g"), "label", F.count("g")).columns) == 51
    assert spark.conf.get("spark.sql.pivotMaxValues") == "10000"
