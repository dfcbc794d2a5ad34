"""Database tables over JDBC, read in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Connection:
    """Where a database is and how to log in; always supplied by the caller."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
        }
        return {name: value for name, value in given.items() if value is not None}


@dataclass(frozen=True)
class Split:
    """Ranges of one column that are read side by side.

    `lower` and `upper` only place the cuts: rows outside of them, and rows without a value,
    are read as well. Take a column whose values are spread evenly, such as the primary key.
    """

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def _subquery(table: str, columns: Sequence[str] | None) -> str:
    wanted = ", ".join(columns) if columns else "*"
    return f"(SELECT {wanted} FROM {table}) AS source"


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    columns: Sequence[str] | None = None,
    split: Split | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """A whole table or some of its columns; the database does the projection.

    Without a `split` one task reads everything, which only suits small tables.
    """
    reader = (
        spark.read.format("jdbc")
        .options(**connection.options())
        .option("dbtable", _subquery(table, columns))
        .option("fetchsize", fetch_size)
    )
    if split is not None:
        reader = reader.options(**split.options())
    return reader.load()


def measure_split(
    spark: SparkSession, connection: Connection, table: str, column: str, partitions: int
) -> Split | None:
    """Cut a table between the least and greatest value of `column`; None if it has no value."""
    query = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"
    bounds = (
        spark.read.format("jdbc").options(**connection.options()).option("query", query).load()
    ).first()
    low, high = bounds
    return None if low is None else Split(column, low, high, partitions)
