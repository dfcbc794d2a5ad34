import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import fraud, insights
from ledgerlake.operators.messages import to_messages
from ledgerlake.plans import tables
from ledgerlake.plans.replay import time_ranges
from ledgerlake.schemas import STORED_TRANSACTION, TRANSACTION_COLUMNS
from ledgerlake.sinks import changelog
from ledgerlake.sinks.keyed_store import batch_upserter
from ledgerlake.sources import files
from ledgerlake.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"
FRAUD_KEYS = [*fraud.DAILY_KEYS, fraud.KEY]


@pytest.fixture()
def events(spark):
    return tables.event_transactions(tables.events(spark, SF_DIR))


def equal(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def write_json(folder, number, rows):
    """One file per micro-batch: files are taken in the order of their times."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{number}.json"
    path.write_text("".join(json.dumps(row) + "\n" for row in rows))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def test_ingest_goes_on_after_a_restart(spark, tmp_path, events):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")

    def run():
        stream = files.message_stream(spark, landing, max_files_per_trigger=2)
        query = jobs.ingest(stream, lake, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW)
        query.awaitTermination()
        return len([p for p in query.recentProgress if p["numInputRows"]])

    to_messages(events, drop_zeros=False).repartition(6).write.mode("append").parquet(landing)
    assert run() == 3
    assert run() == 0
    bad = spark.createDataFrame([(b"not json",), (b'{"transaction_id":1}',)], "value binary")
    bad.coalesce(1).write.mode("append").parquet(landing)
    run()
    # A file the sink did not commit is not part of the table.
    spark.range(1).write.parquet(str(tmp_path / "stray"))
    stray = next((tmp_path / "stray").glob("*.parquet"))
    (tmp_path / "lake" / "stray.parquet").write_bytes(stray.read_bytes())

    stored = files.read_parquet(spark, lake)
    assert stored.columns == TRANSACTION_COLUMNS
    assert dict(stored.dtypes)["timestamp"] == "timestamp"
    assert equal(stored, events)


def test_ingest_by_day_is_pruned(spark, tmp_path, events):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    to_messages(events, drop_zeros=False).write.parquet(landing)
    stream = files.message_stream(spark, landing)
    jobs.ingest(
        stream, lake, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW, by_day=True
    ).awaitTermination()
    stored = files.read_parquet(spark, lake)
    assert equal(stored.select(*TRANSACTION_COLUMNS), events)
    day = stored.where("transaction_date = date '2024-01-05'")
    assert day.count() == events.where(F.to_date("timestamp") == "2024-01-05").count() > 0
    assert "PartitionFilters: [isnotnull(transaction_date" in day._jdf.queryExecution().toString()


def test_fraud_stream_equals_batch(spark, tmp_path, events):
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")
    to_messages(events).repartition(4).write.parquet(landing)
    jobs.watch_fraud(
        files.message_stream(spark, landing, max_files_per_trigger=1),
        changelog.batch_writer(log),
        str(tmp_path / "checkpoint"),
        jobs.AVAILABLE_NOW,
        jobs.KEEP_ALL,
    ).awaitTermination()
    batch = fraud.flag_activity(fraud.daily_activity(events.where("amount <> 0")))
    assert equal(changelog.latest(spark, log, FRAUD_KEYS), batch)
    assert "SortAggregate" not in changelog.latest(
        spark, log, FRAUD_KEYS
    )._jdf.queryExecution().toString()
    changes = spark.read.parquet(f"{log}/changes")
    assert changes.select("batch_id").distinct().count() == 4
    assert changes.count() > batch.count()


def test_lateness_bounds_the_state_of_days(spark, tmp_path, events):
    landing = str(tmp_path / "in")
    rows = tables.events(spark, SF_DIR)
    parts = [
        tables.event_transactions(rows.where(part)) for part in time_ranges(rows, "ts", 4)
    ]

    def run(name, lateness):
        def start():
            return jobs.watch_fraud(
                files.message_stream(spark, f"{landing}-{name}"),
                changelog.batch_writer(str(tmp_path / name)),
                str(tmp_path / f"{name}-checkpoint"),
                jobs.AVAILABLE_NOW,
                lateness,
            )

        for part in parts:
            to_messages(part).write.mode("append").parquet(f"{landing}-{name}")
            query = start()
            query.awaitTermination()
        kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return kept, changelog.latest(spark, str(tmp_path / name), FRAUD_KEYS)

    everything, unbounded = run("unbounded", None)
    few, bounded = run("bounded", "1 day")
    assert equal(unbounded, bounded)
    assert everything == unbounded.count()
    assert few < everything / 4


def test_a_restarted_job_need_not_apply_all_changes_again(spark, tmp_path, events):
    """A start takes a snapshot of the state, whatever came before; a job that goes on logs its changes."""

    def kept(name, trigger):
        query = jobs.watch_fraud(
            files.message_stream(spark, str(tmp_path / "in")),
            changelog.batch_writer(str(tmp_path / name)),
            str(tmp_path / f"{name}-checkpoint"),
            trigger,
            "2 days",
        )
        query.awaitTermination() if trigger == jobs.AVAILABLE_NOW else jobs.drain(query)
        return [file.suffix for file in (tmp_path / f"{name}-checkpoint" / "state").rglob("*")]

    for part in (events.where("amount < 50"), events.where("amount >= 50")):
        to_messages(part).write.mode("append").parquet(str(tmp_path / "in"))
        ended = kept("ended", jobs.AVAILABLE_NOW)
        assert ".zip" in ended and ".changelog" not in ended
    assert ".changelog" in kept("running", None)


def test_late_rows(spark, tmp_path):
    """Late rows are judged by the end of their hour and the watermark of the batch before."""
    arrivals = [["12:00"], ["12:05", "10:05"], ["10:10", "11:40", "12:50"], ["13:00"]]
    for number, times in enumerate(arrivals):
        rows = [
            {"transaction_id": "1", "transaction_type": "a", "timestamp": f"2024-01-01T{t}:00"}
            for t in times
        ]
        write_json(tmp_path / "in", number, rows)
    stream = files.json_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    ids = spark.createDataFrame([(1,)], "account_id int")
    log = str(tmp_path / "log")
    query = jobs.watch_hours(
        stream, ids, changelog.batch_writer(log), str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW
    )
    query.awaitTermination()
    changes = spark.read.parquet(f"{log}/changes").select("batch_id", "hour_start", "tx_count")
    assert {(b, hour.hour, n) for b, hour, n in changes.collect()} == {
        (0, 12, 1), (1, 10, 1), (1, 12, 2), (2, 11, 1), (2, 12, 3), (3, 13, 1)
    }
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress]
    assert sum(dropped) == 1


def test_append_mode_waits_for_the_watermark(spark, tmp_path):
    arrivals = [["12:00"], ["12:05", "10:05"], ["10:10", "11:40", "12:50"], ["13:00"]]
    for number, times in enumerate(arrivals):
        rows = [{"transaction_type": "a", "timestamp": f"2024-01-01T{t}:00"} for t in times]
        write_json(tmp_path / "in", number, rows)
    hours = insights.hourly_activity(files.json_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    out = str(tmp_path / "out")
    jobs.append_to_table(
        hours, out, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW
    ).awaitTermination()
    found = spark.read.parquet(out).select("hour_start", "tx_count").collect()
    assert {(hour.hour, n) for hour, n in found} == {(10, 1), (11, 1)}


def test_json_stream_takes_one_file_at_a_time(spark, tmp_path):
    for number in range(3):
        row = {"transaction_id": str(number), "amount": 1.5, "timestamp": "2024-01-01T00:00:00.000007"}
        write_json(tmp_path / "in", number, [row, {"transaction_id": "b", "amount": "much"}])
    stream = files.json_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    assert stream.columns == TRANSACTION_COLUMNS
    out = str(tmp_path / "out")
    query = jobs.append_to_table(stream, out, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 2]
    stored = spark.read.parquet(out).where("transaction_id <> 'b'").collect()
    assert {row["timestamp"] for row in stored} == {datetime(2024, 1, 1, 0, 0, 0, 7)}
    assert {row["amount"] for row in stored} == {Decimal("1.50")}


def test_errors_stop_the_stream_and_the_batch_is_retried(spark, tmp_path, events):
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")
    to_messages(events).coalesce(1).write.parquet(landing)
    write, seen = changelog.batch_writer(log), []

    def failing(batch, batch_id):
        write(batch, batch_id)
        seen.append(batch_id)
        if len(seen) == 1:
            raise OSError("store is away")

    def run():
        stream = files.message_stream(spark, landing)
        return jobs.watch_fraud(
            stream, failing, str(tmp_path / "checkpoint"), jobs.AVAILABLE_NOW, jobs.KEEP_ALL
        )

    with pytest.raises(Exception, match="store is away"):
        run().awaitTermination()
    run().awaitTermination()
    assert seen == [0, 0]
    batch = fraud.flag_activity(fraud.daily_activity(events.where("amount <> 0")))
    assert equal(changelog.latest(spark, log, FRAUD_KEYS), batch)


def test_keyed_store_is_written_from_the_tasks(spark, tmp_path, events):
    store = tmp_path / "store"
    store.mkdir()
    here = os.getpid()

    def put_many(pairs):
        assert os.getpid() != here
        for key, fields in pairs:
            (store / key.replace(":", "_")).write_text(json.dumps(fields, default=str))

    flagged = fraud.flag_activity(fraud.daily_activity(events)).cache()
    upsert = batch_upserter(
        put_many,
        "activity_key",
        ["daily_transaction_count", "daily_transaction_amount", "is_fraud"],
        rows_per_write=7,
    )
    upsert(flagged, 0)
    upsert(flagged, 0)
    rows = flagged.collect()
    assert len(list(store.iterdir())) == len(rows) > 0
    row = rows[0]
    assert json.loads((store / row["activity_key"].replace(":", "_")).read_text()) == {
        "daily_transaction_count": row["daily_transaction_count"],
        "daily_transaction_amount": str(row["daily_transaction_amount"]),
        "is_fraud": row["is_fraud"],
    }
    flagged.unpersist()


def test_time_ranges(spark):
    rows = tables.events(spark, SF_DIR)
    ranges = time_ranges(rows, "ts", 3)
    counts = [rows.where(part).count() for part in ranges]
    assert sum(counts) == rows.count() and min(counts) > 0
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual" in (
        rows.where(ranges[1])._jdf.queryExecution().toString()
    )
    assert len(time_ranges(rows.limit(0), "ts", 3)) == 1
    same = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as ts from range(3)")
    assert sum(same.where(part).count() for part in time_ranges(same, "ts", 3)) == 3


def test_stored_schema_is_the_wire_schema_with_a_typed_time(spark, events):
    empty = spark.createDataFrame([], STORED_TRANSACTION)
    assert empty.dtypes == events.dtypes


@pytest.mark.parametrize("trigger", [None, {"processingTime": "1 second"}])
def test_a_stream_that_goes_on(spark, tmp_path, events, trigger):
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    to_messages(events).write.parquet(landing)
    query = jobs.ingest(
        files.message_stream(spark, landing), lake, str(tmp_path / "checkpoint"), trigger
    )
    try:
        query.processAllAvailable()
        assert files.read_parquet(spark, lake).count() == events.count()
        to_messages(events).write.mode("append").parquet(landing)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert files.read_parquet(spark, lake).count() == 2 * events.count()
