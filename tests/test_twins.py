"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

QUERIES, TWINS = contract.queries(), contract.oracle_sql()
SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(type(value)), 0 if value is None else value) for value in row))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    columns = sorted(result.columns)
    rows = [tuple(row) for row in result.select(*columns).collect()]
    if name not in TWINS:
        assert rows
        return
    twin = duck.sql(TWINS[name])
    assert sorted(twin.columns) == columns
    kinds = {field.name: SPARK_TO_DUCK[field.dataType.simpleString()] for field in result.schema.fields}
    assert dict(zip(twin.columns, map(str, twin.types))) == kinds
    expected = twin.select(*[f'"{column}"' for column in columns]).fetchall()
    assert in_order(rows) == in_order(expected)


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
