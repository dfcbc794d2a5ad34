"""The batch job: all reports, each written over its last result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ledgerlake.operators.dimensions import account_ids_repeat, cached, customer_accounts
from ledgerlake.operators.enrichment import counted_transactions, sender_totals
from ledgerlake.operators.insights import (
    geo_product,
    monthly_type,
    place_amounts,
    segmentation,
    top_customers,
)

# Names of the result tables.
TOP_CUSTOMERS_TABLE = "insight_top_customers"
MONTHLY_TYPE_TABLE = "insight_monthly_type"
SEGMENTATION_TABLE = "insight_segmentation"
GEO_PRODUCT_TABLE = "insight_geo_product"
HOURLY_TABLE = "insight_hourly_stream"

# The columns that each kind of report reads.
SENDER = "sender_account_id"
MONTHLY_COLUMNS = ("timestamp", "transaction_type", "amount")
PLACE_COLUMNS = ("location", "product_name", "amount")
SENDER_COLUMNS = (SENDER, "amount")


def run_insights(
    transactions: DataFrame | Callable[..., DataFrame],
    accounts: DataFrame,
    customers: DataFrame,
    write: Callable[[DataFrame, str], None],
    types: Sequence[str] | None = None,
    occupations: Sequence[str] | None = None,
    products: Sequence[str] | None = None,
) -> None:
    """Compute every report and hand it with its table name to `write`.

    The account dimension is shared by all of them and kept in memory meanwhile, as are the totals
    per sender that two of them read, and the amounts per place and product that a pivot reads twice.
    Pivots whose columns are not given look them up in the data. `transactions` may be a function that
    gives them with the named columns, if some columns have to be looked up elsewhere: each report asks
    for its own.
    """
    rows = transactions.select if isinstance(transactions, DataFrame) else transactions
    attributes = ("customer_id", "full_name", "customer_segment", "occupation")
    with cached(customer_accounts(accounts, customers)) as dimension:
        repeat = account_ids_repeat(dimension)

        def counted(*columns: str) -> DataFrame:
            # The sender, which only the join needs, is asked for only if the join is made.
            wanted = rows(*columns, SENDER) if repeat else rows(*columns)
            return counted_transactions(wanted, dimension, repeat)

        write(monthly_type(counted(*MONTHLY_COLUMNS), types), MONTHLY_TYPE_TABLE)
        placed = counted(*PLACE_COLUMNS)
        with cached(place_amounts(placed)) as amounts:
            write(geo_product(placed, products, amounts), GEO_PRODUCT_TABLE)
        sent = rows(*SENDER_COLUMNS)
        with cached(sender_totals(sent, dimension, *attributes)) as totals:
            ranked = top_customers(sent, dimension, totals=totals)
            write(ranked, TOP_CUSTOMERS_TABLE)
            by_segment = segmentation(sent, dimension, occupations, totals)
            write(by_segment, SEGMENTATION_TABLE)
