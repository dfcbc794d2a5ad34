"""Exact decimal amounts at the speed of whole numbers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widest decimals summed as integers: their units fit a double, and their parts stay small.
_EXACT_DIGITS = 12

# Units are split at this bit: each part is below 2**20, so that sums of eight trillion rows
# still fit a bigint.
_PART_BITS = 20


def total(rows: DataFrame, column: str) -> Column:
    """The sum of a column of `rows`, of the same type and value as `sum`.

    A sum of decimals wider than eight digits keeps a big decimal object per group and adds to it
    row by row. Here the units (cents) are summed as integers, in a high and a low part, and put
    together once per group.
    """
    kind = rows.schema[column].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision > _EXACT_DIGITS:
        return F.sum(column)
    units = F.rint(F.col(column).cast("double") * 10**kind.scale).cast("bigint")
    high = F.sum(F.shiftright(units, _PART_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**_PART_BITS - 1))).cast("decimal(20,0)")
    whole = (high * F.lit(Decimal(2**_PART_BITS)) + low).cast("decimal(28,0)")
    unit = F.lit(Decimal(1).scaleb(-kind.scale))
    return (whole * unit).cast(f"decimal({kind.precision + 10},{kind.scale})")


def sum_type(rows: DataFrame, column: str) -> T.DataType:
    """The type of the sum of a column."""
    return rows.agg(F.sum(column)).schema[0].dataType


def average_type(rows: DataFrame, column: str) -> T.DataType:
    """The type of the average of a column."""
    return rows.agg(F.avg(column)).schema[0].dataType


def money(amount: Column) -> Column:
    """A double as DECIMAL(10,2). A plain cast goes through the number's text."""
    # Halves of a cent go away from zero, of the number times a hundred.
    size = F.floor(F.abs(amount) * 100 + 0.5)
    cents = (F.signum(amount) * size).cast("bigint").cast("decimal(10,0)")
    return (cents * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
