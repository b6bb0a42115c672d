"""Rows out of objects and arrays held in VARIANT columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def flatten(rows: DataFrame, column: str, path: str = "$", item: str = "item", key: str | None = None) -> DataFrame:
    """One row per element of the array, or value of the object, at ``path``.

    The element replaces ``column`` as ``item``; ``key`` names a column for object keys.
    Nothing at the path, an empty container or a scalar give no row.
    """
    source = F.variant_get(F.col(column).outer(), path, "variant")
    elements = rows.sparkSession.tvf.variant_explode(source).toDF("_pos", "_key", "_item")
    kept = [c for c in rows.columns if c != column]
    keys = [F.col("_key").alias(key)] if key else []
    return rows.lateralJoin(elements).select(*kept, *keys, F.col("_item").alias(item))
