from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake import functions


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_income_bands(spark):
    amounts = [None, -1.0, 0.0, 19999.99, 20000.0, 69999.99, 70000.0, float("nan")]
    found = values(
        spark, [(a,) for a in amounts], "income double", functions.income_category(F.col("income"))
    )
    assert found == ["Unknown", "Low", "Low", "Low", "Medium", "Medium", "High", "High"]


def test_limits_are_strict(spark):
    rows = [(3, "10000.00"), (4, "0.00"), (1, "10000.01"), (1, "0.00")]
    rows = [(count, Decimal(amount)) for count, amount in rows]
    flag = functions.is_suspicious(F.col("n"), F.col("amount"))
    found = values(spark, rows, "n bigint, amount decimal(20,2)", flag)
    assert found == [False, True, True, False]


def test_activity_key(spark):
    key = functions.activity_key(F.col("s"), F.col("d"))
    assert values(spark, [("17", date(2024, 2, 3))], "s string, d date", key) == [
        "user_activity:17:2024-02-03"
    ]


def test_account_key(spark):
    texts = ["3", "03", " 3 ", "x", "", None, "99999999999"]
    found = values(spark, [(t,) for t in texts], "s string", functions.account_key(F.col("s")))
    assert found == [3, 3, 3, None, None, None, 99999999999]


def test_iso_timestamp(spark):
    texts = ["2024-01-02 03:04:05", "2024-01-02 03:04:05.000006", "2024-01-02 03:04:05.1", None]
    moment = F.col("t").cast("timestamp")
    found = values(spark, [(t,) for t in texts], "t string", functions.iso_timestamp(moment))
    expected = [None if t is None else datetime.fromisoformat(t).isoformat() for t in texts]
    assert found == expected


def test_zero_as_null(spark):
    amounts = [Decimal("0.00"), Decimal("-1.50"), None, Decimal("2.00")]
    column = functions.zero_as_null(F.col("a"))
    found = values(spark, [(a,) for a in amounts], "a decimal(10,2)", column)
    assert found == [None, Decimal("-1.50"), None, Decimal("2.00")]
    assert values(spark, [(0.0,), (2.5,)], "a double", column) == [None, 2.5]


def test_total_equals_sum(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 7).alias("k"),
        ((F.col("id") * 7919 - 12345678) * 271 % 10**10).cast("decimal(10,0)").alias("n"),
    )
    cent = F.lit(Decimal("0.01"))
    rows = rows.select("k", (F.col("n") * cent).cast("decimal(10,2)").alias("a"), "n")
    rows = rows.unionAll(
        spark.createDataFrame(
            [(1, Decimal("99999999.99"), None), (2, Decimal("-99999999.99"), None), (9, None, None)],
            rows.schema,
        )
    )
    for column in ("a", "n"):
        exact = F.sum(column).alias("exact")
        fast = functions.total(rows, column).alias("fast")
        both = rows.groupBy("k").agg(exact, fast)
        assert both.schema["exact"].dataType == both.schema["fast"].dataType
        assert both.where("not (exact <=> fast)").isEmpty()
        assert both.count() == 8


def test_total_of_other_types_is_the_plain_sum(spark):
    rows = spark.sql("select cast(1e20 as decimal(38,2)) as wide, 1.5D as number")
    assert rows.agg(functions.total(rows, "wide")).dtypes == rows.agg(F.sum("wide")).dtypes
    assert rows.agg(functions.total(rows, "number")).first()[0] == 1.5


def test_money(spark):
    numbers = [0.0, 6.55, -2547.4, 99999999.99, 0.07, 1e-9, None, 0.125, -0.125, 0.375]
    found = values(spark, [(n,) for n in numbers], "n double", functions.money(F.col("n")))
    assert [None if f is None else str(f) for f in found] == [
        "0.00", "6.55", "-2547.40", "99999999.99", "0.07", "0.00", None, "0.13", "-0.13", "0.38"
    ]
