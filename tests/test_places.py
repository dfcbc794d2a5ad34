"""Sources and sinks that need a server, checked up to the point where they would call it."""

from datetime import datetime
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import tables, transfer_jobs
from ledgerlake.plans.workspace import new_place
from ledgerlake.schemas import ACCOUNT_COLUMNS, CUSTOMER_COLUMNS, STORED_TRANSACTION
from ledgerlake.sinks import jdbc as jdbc_sink
from ledgerlake.sinks import kafka as kafka_sink
from ledgerlake.sinks.files import overwrite_parquet, snapshot
from ledgerlake.sources import files
from ledgerlake.sources import jdbc as jdbc_source
from ledgerlake.sources import kafka as kafka_source

CONNECTION = jdbc_source.Connection("jdbc:none:place", "no.such.Driver", "me", "secret")


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.told, self.result = {}, MagicMock()

    def format(self, name):
        self.told["format"] = name
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def options(self, **values):
        self.told.update(values)
        return self

    def load(self):
        return self.result

    def save(self):
        self.told["saved"] = True


LOGIN = {"url": "jdbc:none:place", "driver": "no.such.Driver", "user": "me", "password": "secret"}


def test_password_is_not_shown():
    assert "secret" not in repr(CONNECTION)
    assert jdbc_source.Connection("u", "d").options() == {"url": "u", "driver": "d"}


def test_jdbc_read():
    spark = MagicMock(read=Recorder())
    jdbc_source.read_table(spark, CONNECTION, "accounts")
    assert spark.read.told == {
        **LOGIN, "format": "jdbc", "dbtable": "(SELECT * FROM accounts) AS source", "fetchsize": 10000
    }


def test_jdbc_read_of_columns_in_parallel():
    spark = MagicMock(read=Recorder())
    split = jdbc_source.Split("account_id", 1, 900, 8)
    jdbc_source.read_table(spark, CONNECTION, "public.accounts", ACCOUNT_COLUMNS, split, 50)
    told = spark.read.told
    assert told["dbtable"] == (
        "(SELECT account_id, customer_id, is_active, initial_balance, date_opened, date_closed,"
        " current_balance FROM public.accounts) AS source"
    )
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"], told["numPartitions"]) == (
        "account_id", "1", "900", "8"
    )
    assert told["fetchsize"] == 50


def test_jdbc_split_is_measured_in_the_database():
    spark = MagicMock(read=Recorder())
    spark.read.result.first.return_value = (3, 70)
    assert jdbc_source.measure_split(spark, CONNECTION, "t", "k", 4) == jdbc_source.Split("k", 3, 70, 4)
    assert spark.read.told["query"] == "SELECT MIN(k) AS low, MAX(k) AS high FROM t"
    spark.read.result.first.return_value = (None, None)
    assert jdbc_source.measure_split(spark, CONNECTION, "t", "k", 4) is None


def test_jdbc_overwrite():
    df = MagicMock(write=Recorder())
    jdbc_sink.overwrite_table(df, CONNECTION, "insight_top_customers")
    assert df.write.told == {
        **LOGIN, "format": "jdbc", "dbtable": "insight_top_customers", "numPartitions": 16,
        "batchsize": 10000, "truncate": True, "mode": "overwrite", "saved": True,
    }


def test_jdbc_append_per_batch(spark):
    batch = MagicMock()
    rows = batch.withColumn.return_value
    rows.write = Recorder()
    jdbc_sink.batch_appender(CONNECTION, "insight_hourly_stream", writers=2)(batch, 7)
    assert batch.withColumn.call_args[0][0] == "batch_id"
    assert rows.write.told["mode"] == "append" and rows.write.told["numPartitions"] == 2
    assert rows.write.told["dbtable"] == "insight_hourly_stream" and rows.write.told["saved"]


def test_jdbc_reaches_the_driver_lookup(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        jdbc_source.read_table(spark, CONNECTION, "accounts")
    with pytest.raises(Exception, match="no.such.Driver"):
        jdbc_sink.overwrite_table(spark.range(1), CONNECTION, "t")


def test_kafka_options():
    login = kafka_source.login_options("SCRAM-SHA-256", "SASL_PLAINTEXT", "the.Module", "me", "secret")
    assert kafka_source.stream_options(
        "broker:9092", "payments", records_per_batch=kafka_source.RECORDS_PER_BATCH, login=login
    ) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "payments",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "100",
        "kafka.sasl.mechanism": "SCRAM-SHA-256",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "kafka.sasl.jaas.config": 'the.Module required username="me" password="secret";',
    }
    free = kafka_source.stream_options("b", "t", "earliest", records_per_batch=None)
    assert "maxOffsetsPerTrigger" not in free and free["startingOffsets"] == "earliest"


def test_kafka_stream_selects_the_value():
    spark = MagicMock(readStream=Recorder())
    kafka_source.message_stream(spark, kafka_source.stream_options("b", "t"))
    assert spark.readStream.told["format"] == "kafka"
    spark.readStream.result.select.assert_called_once_with("value")


def test_kafka_publish():
    messages = MagicMock()
    writer = Recorder()
    messages.select.return_value.write = writer
    kafka_sink.publish(messages, "b", "t", {"kafka.security.protocol": "SASL_SSL"})
    assert writer.told == {
        "format": "kafka", "kafka.bootstrap.servers": "b", "topic": "t",
        "kafka.security.protocol": "SASL_SSL", "saved": True,
    }


def test_csv(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    names = [part.split("`")[1] for part in STORED_TRANSACTION.split(",\n")]
    good = ["1", "2024-01-02T03:04:05.000006", "a", "3", "", "1.50", "", "", "", "", "", "", "hi"]
    bad = ["2", "no time", "b", "4", "", "much", "", "", "", "", "", "", ""]
    (folder / "t.csv").write_text("\n".join(",".join(row) for row in (names, good, bad)))
    first, second = files.read_transactions_csv(spark, str(folder)).orderBy("transaction_id").collect()
    assert first["timestamp"] == datetime(2024, 1, 2, 3, 4, 5, 6)
    assert str(first["amount"]) == "1.50" and first["receiver_account_id"] is None
    assert second["timestamp"] is None and second["amount"] is None
    assert second["sender_account_id"] == "4"


def test_snapshot_replaces_the_last_one(spark, tmp_path):
    path = str(tmp_path / "accounts")
    rows = spark.range(5).select("id", (F.col("id") * 2).alias("twice"))
    snapshot(rows, path)
    assert files.load(spark, path).columns == ["id", "twice"]
    snapshot(rows.limit(2), path, ["twice"])
    assert files.read_parquet(spark, path).columns == ["twice"]
    overwrite_parquet(rows.limit(0), path)
    assert files.read_parquet(spark, path).count() == 0


def test_places_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = new_place(spark, "x"), new_place(spark, "x")
    assert first.startswith(f"{shared}/ledgerlake/x-") and first != second


def test_places_without_a_shared_folder():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.master = "local[2]"
    assert "/ledgerlake/x-" in new_place(session, "x")
    session.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_place(session, "x")


class Database:
    """Stands for the JDBC reads: gives prepared tables and keeps what was asked for."""

    def __init__(self, monkeypatch, **tables):
        self.tables, self.asked = tables, []
        monkeypatch.setattr(transfer_jobs, "measure_split", self.measure_split)
        monkeypatch.setattr(transfer_jobs, "read_table", self.read_table)

    def measure_split(self, spark, connection, table, key, readers):
        return jdbc_source.Split(key, 0, 9, readers)

    def read_table(self, spark, connection, table, columns, split):
        self.asked.append((table, split.column, split.partitions))
        return self.tables[table.split(".")[1]].select(*columns)


def test_snapshot_job(spark, monkeypatch, tmp_path):
    customers = tables.customers(spark, "/root/testdata/sf0.001")
    accounts = tables.accounts(spark, "/root/testdata/sf0.001")
    database = Database(monkeypatch, customers=customers, accounts=accounts)
    for _ in range(2):
        transfer_jobs.snapshot_dimensions(spark, CONNECTION, str(tmp_path))
    assert database.asked[:2] == [("public.customers", "id", 16), ("public.accounts", "account_id", 16)]
    stored = files.read_parquet(spark, str(tmp_path / "customers"))
    assert stored.columns == CUSTOMER_COLUMNS and stored.count() == customers.count()
    stored = files.load(spark, str(tmp_path / "accounts"))
    assert stored.columns == ACCOUNT_COLUMNS and stored.count() == accounts.count()


def test_publish_job(spark, monkeypatch):
    rows = tables.event_transactions(tables.events(spark, "/root/testdata/sf0.001"))
    database = Database(monkeypatch, transactions=rows)
    sent = []
    monkeypatch.setattr(transfer_jobs, "publish", lambda *call: sent.append(call))
    transfer_jobs.publish_transactions(spark, CONNECTION, "b:9092", "payments", {"k": "v"})
    [(messages, *place)] = sent
    assert place == ["b:9092", "payments", {"k": "v"}]
    assert messages.dtypes == [("value", "binary")] and messages.count() == rows.count()
    assert database.asked == [("public.transactions", "transaction_id", 16)]
