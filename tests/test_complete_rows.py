"""No row is lost on the way, whatever fields it lacks; batch and stream judge rows alike."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import fraud, insights
from ledgerlake.operators.enrichment import repeat_by_account
from ledgerlake.operators.lookups import left_lookup
from ledgerlake.plans import queries, tables
from ledgerlake.plans.replay import time_ranges

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["event_id", "ts", "event_type", "user_id", "value"]


@pytest.fixture()
def holes(spark, tmp_path):
    """The given events with fields taken out of some, and some amounts that are zero."""
    rows = tables.events(spark, SF_DIR)
    key = F.col("event_id")
    changed = {name: F.when(key % 11 != k, F.col(name)) for k, name in enumerate(NAMES)}
    changed["value"] = F.when(key % 13 == 0, 0.0).otherwise(changed["value"])
    rows.withColumns(changed).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_every_row_arrives_once(spark, holes):
    rows = tables.events(spark, holes)
    ranges = time_ranges(rows, "ts", 3)
    assert sum(rows.where(part).count() for part in ranges) == rows.count()
    late = queries._late_parts(spark, holes)
    assert sum(part.count() for part in late) == rows.count()


def test_batch_and_stream_of_daily_activity_agree(spark, holes):
    batch = queries.fraud_daily_batch(spark, holes)
    assert batch.where("sender_account_id is null or transaction_date is null").isEmpty()
    assert same(queries.fraud_daily(spark, holes).select(*batch.columns), batch)
    alerts = queries.fraud_alerts_stream(spark, holes).select(*batch.columns)
    assert same(alerts, fraud.fraud_alerts(batch)) and not alerts.isEmpty()


def test_all_accounts_and_senders_without(spark):
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet").count()
    assert tables.accounts(spark, SF_DIR).count() == customers
    enriched = queries.enriched_transactions(spark, SF_DIR)
    assert not enriched.where("account_id is null").isEmpty()


def test_labels_are_looked_up_without_the_report(spark):
    """Labels of segments come from the dimension: their transactions are read once."""
    rows = tables.transactions(spark, SF_DIR, ("sender_account_id", "amount"))
    dimension = queries._report_dimension(spark, SF_DIR)
    found = insights.segmentation(rows, dimension)
    given = insights.segmentation(rows, dimension, tables.OCCUPATIONS)
    assert set(given.columns) <= {*found.columns, *tables.OCCUPATIONS}
    both = [c for c in found.columns if c in given.columns]
    assert same(found.select(*both), given.select(*both))


def test_reports_keep_the_types_of_money(spark):
    rows = tables.transactions(spark, SF_DIR)
    dimension = queries._report_dimension(spark, SF_DIR)
    kinds = lambda df: dict(df.dtypes)
    assert kinds(insights.top_customers(rows, dimension))["total_amount"] == "decimal(20,2)"
    assert kinds(insights.monthly_type(rows, ["A", "N", "R"]))["A"] == "decimal(20,2)"
    assert kinds(insights.segmentation(rows, dimension))["ASIA"] == "decimal(14,6)"
    assert kinds(insights.geo_product(rows, tables.PRODUCTS))["SMALL"] == "decimal(20,2)"
    daily = kinds(fraud.daily_activity(rows))
    assert daily["transaction_date"] == "date"
    assert daily[fraud.AMOUNT] == "decimal(20,2)"


def test_only_repeated_accounts_are_joined(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("2",), ("9",), (None,)], "sender_account_id string")
    once = spark.createDataFrame([(1,), (2,), (None,), (None,)], "account_id long")
    assert repeat_by_account(rows, once) is rows
    twice = spark.createDataFrame([(1,), (2,), (2,), (2,)], "account_id long")
    found = repeat_by_account(rows, twice).groupBy("sender_account_id").count().collect()
    assert {tuple(r) for r in found} == {("1", 1), ("2", 6), ("9", 1), (None, 1)}


def test_rows_without_a_key_are_dealt_out(spark):
    facts = spark.range(4000).select(F.lit(None).cast("long").alias("k"), "id")
    dimension = spark.createDataFrame([(1, "a"), (None, "b")], "d long, name string")
    joined = left_lookup(facts, dimension.hint("merge"), F.col("k"), "d", broadcast_limit=0)
    assert joined.count() == 4000 and joined.where("name is not null").isEmpty()
    assert "_salt" not in joined.columns
