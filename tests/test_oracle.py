"""Every registered query against DuckDB on the same whole tables."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb
import pytest

from cardledger.plans.catalogue import QUERIES
from cardledger.plans.oracle import statements

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DUCK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat()
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(statements())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    duck.execute(statements()[name])
    described = [(d[0], str(d[1])) for d in duck.description]
    expected = duck.fetchall()
    types = {n: DUCK_TYPES.get(t, t.lower()) for n, t in described}
    assert dict(frame.dtypes) == types
    found = _rows(frame.collect(), frame.columns)
    assert found == _rows(expected, [n for n, _ in described])
    assert found, "no rows to compare"
