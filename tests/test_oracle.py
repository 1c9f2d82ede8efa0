"""Every registered query against the same query in DuckDB."""

import os

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as entry
from archive_spark.bindings import QUERIES, SQL

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = spark_rows(entry.queries()[name](spark, FOLDER))
    want = duck_rows(duck, entry.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) and len(want[1]) > 0
    assert got[1] == want[1]
