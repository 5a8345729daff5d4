"""Helpers for the corpus operators' tests."""

from collections import Counter

import duckdb
import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def duck(sf_dir):
    from firmroll.checks.fixtures import TABLES

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) or full rows as a documents table."""

    def make(rows):
        full = [(*r, "en", "s", None if r[1] is None else len(r[1])) if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def same_as_sql(spark, sf_dir, duck):
    """Compare a registered query with its SQL twin, all rows and columns."""

    def compare(name):
        from firmroll.llm import registry

        actual = registry.queries()[name](spark, sf_dir)
        expected = duck.execute(registry.oracle_sql()[name])
        names = [c[0] for c in expected.description]
        assert sorted(actual.columns) == sorted(names)
        found = Counter(tuple(r) for r in actual.select(names).collect())
        wanted = Counter(expected.fetchall())
        assert found == wanted
        assert found
        return found

    return compare
