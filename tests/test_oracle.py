"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gatelens.plans.oracle import SQL
from gatelens.plans.queries import QUERIES

DATA = Path("/root/testdata")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in (DATA / "sf0.01").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, str(DATA / "sf0.01"))
    rows = [tuple(row) for row in result.collect()]
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = cursor.fetchall()
    assert rows, "a query with no result proves nothing"
    assert multiset(result.columns, rows) == multiset(columns, expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) >= set(SQL)


def test_entry(spark):
    assert entry(spark).count() > 0
