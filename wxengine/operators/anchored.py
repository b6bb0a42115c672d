"""Aggregates over whole calendar units, for readings exactly on a unit's start.

Only those anchor readings survive, so no window is needed: every reading counts for the
unit it lies in, one on a boundary also for the unit before (intervals are closed at both
ends), and one hash aggregation, partial before the shuffle, does the rest. It keeps the
anchor reading apart from the others, with what is taken from it as a key; the two rows of
a unit are then added up. The readings are read and deduplicated once. A station with no
reading exactly on the start of a unit has no row for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wxengine.functions.calendar import Grain, interval, trunc_to
from wxengine.functions.cleaning import station_class
from wxengine.operators.measures import WEATHER, Measures


def units_of(at: Column, grain: Grain) -> Column:
    """Starts of the closed units that hold ``at``: one, or two on a boundary."""
    start = trunc_to(at, grain)
    before = start - interval(grain.interval)
    return F.when(at == start, F.array(start, before)).otherwise(F.array(start))


def with_anchor(units: DataFrame, anchors: DataFrame, station: str, at: str) -> DataFrame:
    """Add the columns of each unit's anchor reading.

    Text cannot be aggregated in a hash table, and sorting every reading for it costs more
    than this join of few rows.
    """
    keyed = anchors.withColumnsRenamed({at: "_anchor_at", station: "_anchor_station"})
    same = (F.col(at) == F.col("_anchor_at")) & F.col(station).eqNullSafe(F.col("_anchor_station"))
    return units.join(keyed, same).drop("_anchor_at", "_anchor_station")


def anchored(
    readings: DataFrame,
    grain: Grain,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
    from_anchor: tuple[str, ...] = ("station_name",),
) -> DataFrame:
    """One row per station and unit with an anchor reading, in rolling column names.

    ``from_anchor`` names columns taken from the anchor reading itself.
    """
    given = [f"`{c}`" for c in from_anchor]
    states = readings.selectExpr(f"`{station}`", f"`{at}` AS _at", *given, *measures.reading_state())
    states = states.withColumn("_units", units_of(F.col("_at"), grain))
    states = states.withColumn(at, F.explode("_units")).withColumn("_anchored", F.col("_at") == F.col(at))
    # The anchor reading is a group of its own, so that its text is a key and not aggregated.
    keys = {c: F.when(F.col("_anchored"), F.col(c)) for c in from_anchor}
    groups = states.withColumns(keys).groupBy(at, station, "_anchored", *from_anchor)
    parts = groups.agg(*[F.expr(item) for item in measures.merged_state()])
    whole = f"OVER (PARTITION BY `{at}`, `{station}`)"
    units = parts.selectExpr(
        f"`{station}`", f"`{at}`", "_anchored", *given, *measures.merged_state(over=whole)
    )
    anchored_units = units.filter("_anchored").withColumn("station_type", station_class(station))
    return anchored_units.selectExpr(
        f"`{station}`", *given, "station_type", f"`{at}`", *measures.values(grain.suffix)
    )
