"""The reports over enriched transactions.

Reports that read attributes of the sender take transactions and dimension; the others take the
rows to count, which `enrichment.counted_transactions` gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import average_type, sum_type, total, year_month
from ledgerlake.operators.activity import activity
from ledgerlake.operators.enrichment import sender_totals
from ledgerlake.operators.pivots import NULL_LABEL, pivot, pivot_labels

# Length of the ranking, and the hourly window with its allowed lateness.
RANKING_LENGTH = 10
HOURLY_WINDOW = "1 hour"
HOURLY_LATENESS = "30 minutes"


def top_customers(
    transactions: DataFrame,
    cust_accounts: DataFrame,
    length: int = RANKING_LENGTH,
    drop_unmatched: bool = False,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The customers with the largest total amount, ranked from 1.

    Transactions without a known customer form one group that competes too, unless
    `drop_unmatched`. Equal totals are ordered by customer, so the ranking is repeatable.
    Each task keeps its own best `length` rows; only those are merged and numbered. `totals`:
    `sender_totals` with the named attributes, where several reports share it.
    """
    if totals is None:
        totals = sender_totals(transactions, cust_accounts, "customer_id", "full_name")
    if drop_unmatched:
        totals = totals.where(F.col("customer_id").isNotNull())
    ordering = [
        F.col("total_amount").desc_nulls_last(),
        F.col("customer_id").asc_nulls_first(),
        F.col("full_name").asc_nulls_first(),
    ]
    amount = F.sum("amount_sum").cast(sum_type(transactions, "amount"))
    customers = totals.groupBy("customer_id", "full_name").agg(amount.alias("total_amount"))
    best = customers.orderBy(*ordering).limit(length)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*ordering)))


def monthly_type(counted: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Amount per month, one column per transaction type.

    Rows are first summed per day, which is cheaper to tell than the text of the month.
    """
    day = F.to_date("timestamp").alias("day")
    daily = counted.groupBy(day, "transaction_type").agg(total(counted, "amount").alias("amount"))
    month = year_month(F.col("day")).alias("year_month")
    amount = F.sum("amount").cast(sum_type(counted, "amount"))
    if types is None:  # from the rows: a scan of one column instead of the sums once more
        types = pivot_labels(counted, "transaction_type")
    return pivot(daily, month, "transaction_type", amount, types)


def segmentation(
    transactions: DataFrame,
    cust_accounts: DataFrame,
    occupations: Sequence[str] | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Average amount per customer segment, one column per occupation.

    Without given occupations there is a column for each of the dimension's and one for none.
    """
    if totals is None:
        totals = sender_totals(transactions, cust_accounts, "customer_segment", "occupation")
    amount = F.sum("amount_sum").cast(sum_type(transactions, "amount"))
    average = F.try_divide(amount, F.sum("amount_count"))
    average = average.cast(average_type(transactions, "amount"))
    if occupations is None:
        occupations = sorted({*pivot_labels(cust_accounts, "occupation"), NULL_LABEL})
    return pivot(totals, F.col("customer_segment"), "occupation", average, occupations)


def place_amounts(counted: DataFrame) -> DataFrame:
    """Amount per location and product, one row each."""
    return counted.groupBy("location", "product_name").agg(total(counted, "amount").alias("amount"))


def geo_product(
    counted: DataFrame, products: Sequence[str] | None = None, amounts: DataFrame | None = None
) -> DataFrame:
    """Amount per location, one column per product.

    `amounts`: `place_amounts`, where they are kept, so that looking up the products reads only them.
    """
    if amounts is None:
        return pivot(counted, F.col("location"), "product_name", total(counted, "amount"), products)
    amount = F.sum("amount").cast(sum_type(counted, "amount"))
    return pivot(amounts, F.col("location"), "product_name", amount, products)


def hourly_activity(transactions: DataFrame, lateness: str | None = HOURLY_LATENESS) -> DataFrame:
    """Count and amount per hour and transaction type.

    On a stream, rows later than `lateness` are dropped and finished hours leave the state;
    a batch has no late rows.
    """
    if transactions.isStreaming and lateness is not None:
        transactions = transactions.withWatermark("timestamp", lateness)
    hour = F.window("timestamp", HOURLY_WINDOW).alias("hour")
    hours = activity(transactions, [hour, "transaction_type"], "tx_count", "total_amount")
    bounds = [F.col(f"hour.{side}").alias(f"hour_{side}") for side in ("start", "end")]
    return hours.select(*bounds, *hours.columns[1:])
