"""Counted and summed transactions per group, in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import total


def activity(
    transactions: DataFrame, by: list[Column | str], count_as: str, amount_as: str
) -> DataFrame:
    """Number and amount of the transactions of each group; tasks reduce their part first."""
    measures = [F.count("*").alias(count_as), total(transactions, "amount").alias(amount_as)]
    return transactions.groupBy(*by).agg(*measures)
