"""Comparison of a Spark result with the rows DuckDB gives for the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    expected = connection.execute(sql)
    expected_columns = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    columns = frame.columns
    if sorted(columns) != sorted(expected_columns):
        return f"columns differ: {set(columns) ^ set(expected_columns)}"
    got = _bag([tuple(r) for r in frame.collect()], columns)
    want = _bag(expected_rows, expected_columns)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())};"
        f" {sum(extra.values())} extra, for example {next(iter(extra), None)};"
        f" {sum(missing.values())} missing, for example {next(iter(missing), None)}"
    )
