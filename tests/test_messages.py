import json
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators.messages import (
    fraud_rows,
    lake_rows,
    parse_messages,
    rejected_rows,
    to_messages,
)
from ledgerlake.schemas import STORED_TRANSACTION, TRANSACTION_COLUMNS


def parsed(spark, *texts):
    messages = spark.createDataFrame([(None if t is None else t.encode(),) for t in texts],
                                     "value binary")
    return parse_messages(messages)


def transactions(spark, *rows):
    full = [tuple(row.get(name) for name in TRANSACTION_COLUMNS) for row in rows]
    return spark.createDataFrame(full, STORED_TRANSACTION)


def test_fields_that_do_not_fit_are_null(spark):
    rows = parsed(
        spark,
        '{"transaction_id":7,"timestamp":"2024-12-01T10:00:00.123456","amount":12.345}',
        '{"transaction_id":8,"timestamp":"bad","amount":"12.3"}',
        '{"transaction_id":9,"amount":123456789012.5,"timestamp":"2024-12-01"}',
        '{"transaction_id":10,"amount":NaN,"timestamp":"2024-12-01T10:00:00+07:00"}',
    )
    found = [tuple(row) for row in rows.select("transaction_id", "timestamp", "amount").collect()]
    assert found == [
        ("7", datetime(2024, 12, 1, 10, 0, 0, 123456), Decimal("12.35")),
        ("8", None, Decimal("12.30")),
        ("9", datetime(2024, 12, 1), None),
        ("10", datetime(2024, 12, 1, 3), None),
    ]


def test_unreadable_messages_are_rejected(spark):
    rows = parsed(spark, "not json", "", None, '{"transaction_id":1', "[1]")
    assert all(value is None for row in rows.collect() for value in row)
    assert lake_rows(rows).count() == 0
    assert fraud_rows(rows).count() == 0
    assert rejected_rows(rows).count() == 5


def test_filters(spark):
    base = {
        "transaction_id": "1",
        "timestamp": datetime(2024, 1, 1),
        "transaction_type": "view",
        "sender_account_id": "3",
        "amount": Decimal("5.00"),
    }
    gaps = [None, "transaction_id", "timestamp", "transaction_type", "sender_account_id", "amount"]
    rows = [{**base, **({gap: None} if gap else {}), "subtype": gap} for gap in gaps]
    df = transactions(spark, *rows)

    def kept(frame):
        return {row["subtype"] for row in frame.collect()}

    assert kept(lake_rows(df)) == {None, "sender_account_id", "amount"}
    assert kept(fraud_rows(df)) == {None, "transaction_type"}
    assert kept(rejected_rows(df)) == {"transaction_id", "timestamp", "transaction_type"}


def test_message_text(spark):
    df = transactions(
        spark,
        {
            "transaction_id": "1",
            "timestamp": datetime(2024, 1, 2, 3, 4, 5),
            "amount": Decimal("0.00"),
            "transaction_fee": Decimal("1.50"),
            "transaction_message": 'a "quoted" \\ line\nwith ümlaut',
        },
    )
    message = json.loads(bytes(to_messages(df).first()["value"]).decode())
    assert list(message) == TRANSACTION_COLUMNS
    assert message == {
        **dict.fromkeys(TRANSACTION_COLUMNS),
        "transaction_id": "1",
        "timestamp": "2024-01-02T03:04:05",
        "transaction_fee": 1.5,
        "transaction_message": 'a "quoted" \\ line\nwith ümlaut',
    }
    kept = json.loads(bytes(to_messages(df, drop_zeros=False).first()["value"]).decode())
    assert kept["amount"] == 0


def test_only_named_columns_may_be_missing(spark):
    df = spark.createDataFrame([(5, 2.0)], "transaction_id int, amount double")
    with pytest.raises(ValueError, match="timestamp"):
        to_messages(df, absent=["sender_account_id"])
    absent = [name for name in TRANSACTION_COLUMNS if name not in df.columns]
    message = json.loads(bytes(to_messages(df, absent=absent).first()["value"]).decode())
    assert message == {**dict.fromkeys(TRANSACTION_COLUMNS), "transaction_id": 5, "amount": 2.0}


money = st.none() | st.decimals(
    min_value=Decimal("-99999999.99"), max_value=Decimal("99999999.99"), places=2
)
text = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=20)
moments = st.none() | st.datetimes(datetime(1970, 1, 2), datetime(2200, 1, 1)).map(
    lambda moment: moment.replace(fold=0)
)


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(text, moments, money, text), max_size=20))
def test_publish_then_parse_gives_the_row_back(spark, drawn):
    names = ("transaction_id", "timestamp", "amount", "transaction_message")
    df = transactions(spark, *[dict(zip(names, row, strict=True)) for row in drawn])
    back = parse_messages(to_messages(df, drop_zeros=False)).select(*names).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, drawn))
    dropped = parse_messages(to_messages(df)).select("amount").collect()
    expected = [None if row[2] == 0 else row[2] for row in drawn]
    assert [row[0] for row in dropped] == expected


def test_each_message_is_parsed_once(spark):
    for rows in (lake_rows(parsed(spark, "{}")), fraud_rows(parsed(spark, "{}"))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
