"""Every registered query with SQL equals DuckDB on the smallest tables."""

import __spark_entry__ as entry
import pytest
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert ok, note


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1473
