"""Queries that SQL can express, against DuckDB on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from wxengine.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert "pipeline" in entry.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None
