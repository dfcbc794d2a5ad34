"""Every registered query against its SQL on a second engine."""

import math
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as contract
from ledgerlake.plans import oracle
from ledgerlake.plans import queries as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def sf_dir(request):
    return f"{DATA}/{request.param}"


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{Path(sf_dir) / name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(contract.queries())
    assert set(registry.queries()) == set(oracle.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_equal_rows(spark, sf_dir, other_engine, name):
    result = contract.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    found = [tuple(plain(row[c]) for c in columns) for row in result.collect()]

    answer = other_engine.execute(contract.oracle_sql()[name])
    names = [item[0] for item in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = [tuple(plain(row[p]) for p in places) for row in answer.fetchall()]

    assert len(found) == len(expected) > 0
    assert ordered(found) == ordered(expected)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["customer_id", "full_name", "total_amount", "rank"]
    assert result.count() == 10
