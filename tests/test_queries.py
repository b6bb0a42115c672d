"""Every registered query against DuckDB on the smallest data set."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from wxengine.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_each_query_has_reference_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert difference(result, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
