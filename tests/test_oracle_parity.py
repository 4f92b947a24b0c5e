"""Every query against its DuckDB statement on the small driver tables."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__
from checks.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def simple(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    return value


def ordered(rows, columns):
    """Rows as tuples of the columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(simple(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    found = ordered(result.collect(), result.columns)
    assert found == ordered(cursor.fetchall(), columns)
    assert found, "a query without rows proves nothing"


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
