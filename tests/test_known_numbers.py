"""Counts and totals of the given tables at sf0.01, as FIXTURES.md states them."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries.REGISTERED[name](spark, SF_DIR)


def test_dimension(run):
    assert run("scan_customers").count() == 1500
    assert run("scan_customers").where("income is null").count() == 150
    assert run("cust_accounts").count() == 1500
    categories = run("income_category").select("income_category").distinct().collect()
    assert {row[0] for row in categories} == {"Unknown", "Low", "Medium", "High"}


def test_enriched(run):
    rows = run("enriched_transactions")
    assert rows.count() == 60000
    assert rows.where("full_name is null").count() == 5703
    assert rows.where("account_id is null").count() == 2608
    assert rows.select("transaction_id").distinct().count() == 45832


def test_ranking(run):
    first, second, *_ = run("top_customers").orderBy("rank").collect()
    assert (first["customer_id"], str(first["total_amount"])) == (None, "300783364.97")
    assert (second["customer_id"], str(second["total_amount"])) == (1180, "7416027.99")


def test_months(run):
    assert run("monthly_type").count() == 83


def test_days_and_hours(run):
    days = run("fraud_daily_batch")
    assert days.count() == 4006
    flagged = days.where("is_fraud")
    assert flagged.count() == run("fraud_alerts").count() == 2034
    assert flagged.where(F.col("daily_transaction_count") > 3).count() == 845
    assert run("hourly_batch").count() == 3385
