"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from farelake.plans import catalog, oracle

TABLES = "lineitem orders"
QUERIES = catalog.all_queries()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck(small_tables):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{small_tables}/{table}.parquet'")
    yield connection
    connection.close()


def rows_of(table):
    names = sorted(table.column_names)
    return sorted(tuple(repr(row[name]) for name in names) for row in table.to_pylist())


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, small_tables, name):
    mine = QUERIES[name](spark, small_tables).toArrow()
    theirs = duck.sql(SQL[name]).to_arrow_table()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    for column in mine.column_names:
        assert mine.schema.field(column).type == theirs.schema.field(column).type, column
    assert rows_of(mine) == rows_of(theirs)
