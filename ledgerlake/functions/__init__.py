from ledgerlake.functions.money import average_type, money, sum_type, total
from ledgerlake.functions.scalars import (
    account_key,
    activity_key,
    income_category,
    iso_timestamp,
    is_suspicious,
    year_month,
    zero_as_null,
)

__all__ = [
    "account_key",
    "activity_key",
    "average_type",
    "income_category",
    "iso_timestamp",
    "is_suspicious",
    "money",
    "sum_type",
    "total",
    "year_month",
    "zero_as_null",
]
