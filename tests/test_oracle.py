"""Every registered query against its SQL twin on DuckDB, over whole tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from firmroll.checks import oracle, queries
from firmroll.checks.fixtures import TABLES

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLE.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    actual = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLE[name])
    columns = sorted(actual.columns)
    assert columns == sorted(column[0] for column in expected.description)
    order = [[column[0] for column in expected.description].index(column) for column in columns]
    wanted = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    found = Counter(tuple(row) for row in actual.select(columns).collect())
    assert found == wanted
    assert sum(found.values()) > 0
