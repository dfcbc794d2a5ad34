"""Daily activity per sender and the suspicious part of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import activity_key, is_suspicious
from ledgerlake.operators.activity import activity

# Columns of the daily activity.
DAILY_KEYS = ("sender_account_id", "transaction_date")
KEY = "activity_key"
COUNT = "daily_transaction_count"
AMOUNT = "daily_transaction_amount"

_UTC_NAMES = {"UTC", "ETC/UTC", "GMT", "ETC/GMT", "Z", "+00:00", "UCT", "ZULU", "ETC/UCT"}


def daily_activity(transactions: DataFrame, lateness: str | None = None) -> DataFrame:
    """Count and amount per sender and day.

    Without `lateness`, days never close: any late row still counts, and a stream keeps every
    day in its state. With it, a stream groups by day windows under a watermark, so days that
    closed leave the state and later rows are dropped. Windows are cut at UTC midnight, hence
    the session must run in UTC then.
    """
    if lateness is None:
        day = F.to_date("timestamp")
    else:
        zone = transactions.sparkSession.conf.get("spark.sql.session.timeZone")
        if zone.upper() not in _UTC_NAMES:
            raise ValueError(f"day windows need a UTC session, not {zone}")
        transactions = transactions.withWatermark("timestamp", lateness)
        day = F.window("timestamp", "1 day")
    grouped = activity(transactions, ["sender_account_id", day.alias("day")], COUNT, AMOUNT)
    date = F.col("day") if lateness is None else F.to_date("day.start")
    amount = F.coalesce(AMOUNT, F.lit(0).cast("decimal(1,0)"))
    return grouped.select(
        "sender_account_id", date.alias("transaction_date"), COUNT, amount.alias(AMOUNT)
    )


def flag_activity(daily: DataFrame) -> DataFrame:
    """Add the fraud flag and the text key of each sender and day."""
    flag = is_suspicious(F.col(COUNT), F.col(AMOUNT))
    key = activity_key(*[F.col(name) for name in DAILY_KEYS])
    return daily.withColumns({"is_fraud": flag, KEY: key})


def fraud_alerts(flagged: DataFrame) -> DataFrame:
    """The flagged days, to be alerted on."""
    return flagged.where("is_fraud")


def suspicious_transactions(lake: DataFrame, alerts: DataFrame) -> DataFrame:
    """The transactions of the flagged senders' days, from a table with a directory per day.

    Alerts that are small enough to be broadcast also tell which directories are read at all.
    """
    flagged = fraud_alerts(alerts).select(*DAILY_KEYS).distinct()
    return lake.join(flagged, list(DAILY_KEYS), "left_semi")
