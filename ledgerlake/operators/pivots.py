"""Pivots that keep every value, the missing one included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_LABEL = "null"


def pivot_labels(rows: DataFrame, column: str, at_most: int | None = None) -> list[str]:
    """Labels that occur in `column`, sorted; they become columns, so they are few.

    More than `at_most` is an error, not a cut, and no more than that come to the driver. Without
    it, the session's bound on the columns of a pivot holds (`spark.sql.pivotMaxValues`).
    """
    if at_most is None:
        at_most = int(rows.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    label = F.coalesce(F.col(column).cast("string"), F.lit(NULL_LABEL)).alias("label")
    found = rows.select(label).distinct().limit(at_most + 1).collect()
    if len(found) > at_most:
        raise ValueError(f"{column} has more than {at_most} values; pass the wanted columns")
    return sorted(row["label"] for row in found)


def pivot(
    rows: DataFrame,
    group: Column,
    column: str,
    value: Column,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """One row per `group`, one column per value of `column`; cells without rows are null.

    With `labels` the input is read once and a value outside of them raises an error. Without,
    the labels are looked up first, which reads `column` once more and is bounded (`pivot_labels`).
    """
    if labels is None:
        labels = pivot_labels(rows, column)
    labels = list(labels)
    label = F.coalesce(F.col(column).cast("string"), F.lit(NULL_LABEL))
    unlisted = F.raise_error(F.concat(F.lit(f"{column} has a value without a column: "), label))
    checked = F.when(label.isin(labels), label).otherwise(unlisted.cast("string"))
    return (
        rows.withColumn("_label", checked).groupBy(group).pivot("_label", labels).agg(value)
    )
