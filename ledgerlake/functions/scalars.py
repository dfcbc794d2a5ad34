"""Scalar column expressions. All of them stay inside Spark's code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds and labels of the income bands.
LOW_INCOME_BELOW = 20000
MEDIUM_INCOME_BELOW = 70000
INCOME_LABELS = ("Unknown", "Low", "Medium", "High")

# Limits of one sender's activity on one day, and the prefix of its key.
DAILY_COUNT_LIMIT = 3
DAILY_AMOUNT_LIMIT = 10000
ACTIVITY_PREFIX = "user_activity"


def income_category(income: Column) -> Column:
    """Label an income band; a missing income is labelled too."""
    unknown, low, medium, high = INCOME_LABELS
    return (
        F.when(income.isNull(), unknown)
        .when(income < LOW_INCOME_BELOW, low)
        .when(income < MEDIUM_INCOME_BELOW, medium)
        .otherwise(high)
    )


def is_suspicious(daily_count: Column, daily_amount: Column) -> Column:
    """True where a day's count or amount lies strictly above its limit."""
    return (daily_count > DAILY_COUNT_LIMIT) | (daily_amount > DAILY_AMOUNT_LIMIT)


def activity_key(sender: Column, day: Column) -> Column:
    """Text key of one sender's activity on one day."""
    return F.concat_ws(":", F.lit(ACTIVITY_PREFIX), sender, day.cast("string"))


def account_key(sender: Column) -> Column:
    """Account number held in a text column; NULL where the text is no number."""
    return sender.try_cast("bigint")


def zero_as_null(value: Column) -> Column:
    """Messages carry no zero amounts: they are published as null."""
    return F.nullif(value, F.lit(0).cast("decimal(1,0)"))


def iso_timestamp(moment: Column) -> Column:
    """ISO-8601 text in the session time zone; whole seconds carry no fraction."""
    text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def year_month(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")
