"""Reading what a stream stores, while it is gathered into larger files."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import fraud
from ledgerlake.operators.messages import to_messages
from ledgerlake.plans import queries, tables
from ledgerlake.sinks import lake
from ledgerlake.sinks.folders import Folder, numbers
from ledgerlake.sources import files
from ledgerlake.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return tables.event_transactions(tables.events(spark, SF_DIR)).where("amount <> 0").cache()


def equal(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


class Place:
    def __init__(self, spark, path, events, by_day):
        self.spark, self.by_day = spark, by_day
        self.lake, self.place = f"{path}/lake", f"{path}/gathered"
        self.landing, self.checkpoint = f"{path}/in", f"{path}/checkpoint"
        self.events, self.stored = events, events.where("false")

    def store(self, k):
        part = self.events.where(F.col("transaction_id").cast("int") % 4 == k)
        to_messages(part).repartition(4).write.mode("append").parquet(self.landing)
        stream = files.message_stream(self.spark, self.landing)
        jobs.ingest(stream, self.lake, self.checkpoint, jobs.AVAILABLE_NOW, self.by_day).awaitTermination()
        self.stored = self.stored.unionByName(part)

    def read(self):
        return lake.read(self.spark, self.lake, self.place)

    def compact(self):
        return lake.compact(self.spark, self.lake, self.place, partition_by=files.DAY if self.by_day else None)

    def is_whole(self):
        return equal(self.stored, self.read())


@pytest.mark.parametrize("by_day", [False, True])
def test_each_row_once_before_while_and_after(spark, tmp_path, events, by_day, monkeypatch):
    place = Place(spark, tmp_path, events, by_day)
    place.store(0)
    place.store(1)
    assert place.is_whole()
    before = place.read()
    seen = []
    write = lake.write_sized

    def slow(rows, path, *options):
        seen.append(place.is_whole())
        write(rows, path, *options)
        seen.append(place.is_whole())
        place.store(2)  # the stream goes on
        seen.append(place.is_whole())

    monkeypatch.setattr(lake, "write_sized", slow)
    assert place.compact() == 1
    monkeypatch.undo()
    assert seen == [True] * 3 and place.is_whole()
    assert before.count() == events.where("cast(transaction_id as int) % 4 < 2").count()  # as it was
    assert len(place.read().inputFiles()) < len(files.read_parquet(spark, place.lake).inputFiles())
    assert place.compact() == 2
    place.store(3)
    assert place.is_whole() and place.compact() == 3 and place.is_whole()
    assert place.compact() is None
    fresh = set(files.read_parquet(spark, place.lake).inputFiles()) & set(place.read().inputFiles())
    assert not fresh


def test_a_broken_compaction_is_never_read(spark, tmp_path, events, monkeypatch):
    place = Place(spark, tmp_path, events, False)
    place.store(0)

    def half(rows, path, *options):
        rows.limit(3).write.parquet(path)
        raise OSError("away")

    monkeypatch.setattr(lake, "write_sized", half)
    with pytest.raises(OSError):
        place.compact()
    monkeypatch.undo()
    assert place.is_whole()
    assert place.compact() == 2 and place.is_whole()
    assert numbers(spark, f"{place.place}/finished") == [2]


def test_two_compactions_at_a_time(spark, tmp_path, events, monkeypatch):
    place = Place(spark, tmp_path, events, False)
    place.store(0)
    write, first = lake.write_sized, []

    def overtaken(rows, path, *options):
        write(rows, path, *options)
        if not first:
            first.append(True)
            place.compact()

    monkeypatch.setattr(lake, "write_sized", overtaken)
    with pytest.raises(RuntimeError, match="another compaction"):
        place.compact()
    assert place.is_whole()


def test_only_the_days_of_a_report_are_read(spark, tmp_path, events):
    place = Place(spark, tmp_path, events, True)
    place.store(0)
    days = files.read_days(spark, place.lake, queries.FIRST_DAY, queries.LAST_DAY)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    wanted = place.stored.where(F.to_date("timestamp").between(queries.FIRST_DAY, queries.LAST_DAY))
    assert 0 < days.count() == wanted.count() < place.stored.count()
    assert files.read_days(spark, place.lake).count() == place.stored.count()
    assert files.read_days(spark, place.lake, last=queries.FIRST_DAY).where("transaction_date > '2024-01-08'").isEmpty()


def test_alerts_tell_which_days_are_read(spark, tmp_path, events):
    place = Place(spark, tmp_path, events, True)
    place.store(0)
    rows = files.read_days(spark, place.lake)
    daily = fraud.flag_activity(fraud.daily_activity(place.stored))
    alerts = daily.where("transaction_date = '2024-01-09'")
    found = fraud.suspicious_transactions(rows, alerts)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    senders = {r[0] for r in alerts.where("is_fraud").select("sender_account_id").collect()}
    want = place.stored.where(F.to_date("timestamp") == "2024-01-09").where(F.col("sender_account_id").isin(senders))
    assert 0 < found.count() == want.count()


def test_claims_are_exclusive(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "claims"))
    assert folder.claim("a") and not folder.claim("a")
    assert [folder.claim_next("7."), folder.claim_next("7."), folder.claim_next("8.", 3)] == [0, 1, 3]
    assert sorted(n for n in folder.names() if not n.endswith(".crc")) == ["7.0", "7.1", "8.3", "a"]
