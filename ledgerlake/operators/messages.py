"""Transactions to JSON messages and back. The same code serves batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.functions import iso_timestamp, zero_as_null
from ledgerlake.schemas import TRANSACTION_COLUMNS, WIRE_TRANSACTION

# Columns that must be present for a row to be kept.
LAKE_REQUIRED = ("transaction_id", "timestamp", "transaction_type")
FRAUD_REQUIRED = ("transaction_id", "sender_account_id", "amount", "timestamp")

# What is counted of messages, and the reason of those of which no field can be read.
READ, KEPT, REJECTED, UNREADABLE = "read", "kept", "rejected", "unreadable"

# Numeric columns that are published without zeros.
PUBLISHED_NUMBERS = ("amount", "transaction_fee", "product_amount")


def as_published(transactions: DataFrame) -> DataFrame:
    """Transactions as they are published: without zeros in their numbers."""
    numbers = [name for name in PUBLISHED_NUMBERS if name in transactions.columns]
    return transactions.withColumns({name: zero_as_null(F.col(name)) for name in numbers})


def to_messages(
    transactions: DataFrame, drop_zeros: bool = True, absent: Sequence[str] = ()
) -> DataFrame:
    """One binary `value` per transaction: a JSON object with explicit nulls.

    Every message has all fields. A column that the input lacks is an error, unless it is named in
    `absent`: then it is published as null.
    """
    missing = set(TRANSACTION_COLUMNS) - set(transactions.columns) - set(absent)
    if missing:
        raise ValueError(f"columns to publish are missing: {', '.join(sorted(missing))}")

    def field(name: str) -> Column:
        if name not in transactions.columns:
            return F.lit(None).cast("string")
        column = F.col(name)
        if name == "timestamp":
            return iso_timestamp(column)
        if drop_zeros and name in PUBLISHED_NUMBERS:
            return zero_as_null(column)
        return column

    body = F.struct(*[field(name).alias(name) for name in TRANSACTION_COLUMNS])
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return transactions.select(text.cast("binary").alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode, parse and type messages.

    A message that is no JSON object yields a row of nulls, a field that does not fit
    its type yields a null field; neither stops a stream.
    """
    return _parsed(messages)


def _parsed(messages: DataFrame, *also: Column) -> DataFrame:
    data = F.from_json(F.col("value").cast("string"), WIRE_TRANSACTION)
    # `inline` keeps filters on the fields behind the parser, which so reads each message once;
    # pushed in front of it, every field they test would be parsed out of the message again.
    rows = messages.select(*also, F.inline(F.array(data)))
    return rows.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))


def _complete(required: tuple[str, ...]) -> Column:
    condition = F.lit(True)
    for name in required:
        condition = condition & F.col(name).isNotNull()
    return condition


def lake_rows(parsed: DataFrame) -> DataFrame:
    """Rows complete enough to be stored."""
    return parsed.filter(_complete(LAKE_REQUIRED))


def rejected_rows(parsed: DataFrame) -> DataFrame:
    """The rows `lake_rows` leaves out."""
    return parsed.filter(~_complete(LAKE_REQUIRED))


def rejection(required: Sequence[str] = LAKE_REQUIRED) -> Column:
    """Why a parsed row is not complete: no field could be read, or the first that lacks. Null if it is."""
    unread = F.coalesce(*[F.col(name).cast("string") for name in TRANSACTION_COLUMNS]).isNull()
    reason = F.when(unread, UNREADABLE)
    for name in required:
        reason = reason.when(F.col(name).isNull(), f"no {name}")
    return reason


def counted(
    parsed: DataFrame, observation: str | Observation, required: Sequence[str] = LAKE_REQUIRED
) -> DataFrame:
    """The same rows; how many were read, kept and rejected, and why, is counted as they pass by.

    A batch tells the counts by its `Observation`, a stream by name in the progress of each
    micro-batch (`streaming.progress`). No second reading is made.
    """
    reason = rejection(required)
    reasons = [UNREADABLE, *[f"no {name}" for name in required]]
    return parsed.observe(
        observation,
        F.count("*").alias(READ),
        F.count_if(reason.isNull()).alias(KEPT),
        F.count_if(reason.isNotNull()).alias(REJECTED),
        *[F.count_if(reason == text).alias(text) for text in reasons],
    )


def rejected_messages(messages: DataFrame, required: Sequence[str] = LAKE_REQUIRED) -> DataFrame:
    """The messages that give no complete row, as they came, with the reason."""
    rows = _parsed(messages, F.col("value"))
    return rows.select("value", rejection(required).alias("reason")).where("reason is not null")


def fraud_rows(parsed: DataFrame) -> DataFrame:
    """Rows complete enough to count towards a sender's daily activity."""
    return parsed.filter(_complete(FRAUD_REQUIRED))
