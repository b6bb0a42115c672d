"""Columns chosen and renamed by their suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wxengine.functions.calendar import Grain

IDENTITY = ("station_id", "station_name", "station_type", "measure_at")


def grain_columns(columns: list[str], grain: Grain) -> list[str]:
    """Rolling columns of one grain, whatever the case of their names."""
    endings = tuple(f"_{grain.suffix}_{kind}" for kind in ("sum", "average", "max"))
    return [c for c in columns if c.lower().endswith(endings)]


def published_name(column: str, grain: Grain) -> str:
    """Published name of a rolling column.

    Averages lose their suffix, sums keep ``_sum`` (sunshine loses it together with its
    sampling step), maxima end in ``max`` without an underscore.
    """
    column = column.lower()
    if column == f"sunshine_duration_10min_{grain.suffix}_sum":
        return "sunshine_duration"
    for kind, ending in (("sum", "_sum"), ("average", ""), ("max", "max")):
        suffix = f"_{grain.suffix}_{kind}"
        if column.endswith(suffix):
            return column[: -len(suffix)] + ending
    return column


def publish(rolled: DataFrame, grain: Grain) -> DataFrame:
    """Identity columns and one grain's columns under their published names."""
    chosen = grain_columns(rolled.columns, grain)
    renamed = {c: published_name(c, grain) for c in chosen}
    return rolled.select(*IDENTITY, *chosen).withColumnsRenamed(renamed)
