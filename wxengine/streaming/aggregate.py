"""Calendar aggregates of a stream of readings.

RANGE windows are not defined on streams, so aggregates use tumbling windows. These are
half-open; a reading on a boundary is therefore counted a second time one microsecond
earlier, which closes the window before it. Months have no tumbling window: keep day
states as a stream and build months from them with ``operators.day_states``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wxengine.functions.calendar import (
    DAILY,
    HOURLY,
    WEEKLY,
    Grain,
    instant_to_wall,
    is_anchor,
    midnight,
    wall_to_instant,
)
from wxengine.functions.cleaning import station_class
from wxengine.operators.day_states import day_aggregates
from wxengine.operators.measures import WEATHER, Measures


def _unit_window(instant: str, grain: Grain) -> Column:
    # The epoch was a Thursday, so weeks that start on Monday are shifted by four days.
    if grain == WEEKLY:
        return F.window(instant, "1 week", "1 week", "4 days")
    if grain in (HOURLY, DAILY):
        return F.window(instant, grain.interval)
    raise ValueError("no tumbling window for months; use stream_day_states")


def dedup_stream(readings: DataFrame, delay: str) -> DataFrame:
    """First delivery of each station and time, remembered for ``delay`` of event time."""
    return (
        readings.withColumn("_instant", wall_to_instant(F.col("measure_at")))
        .withWatermark("_instant", delay)
        .dropDuplicatesWithinWatermark(["station_id", "_instant"])
        .drop("_instant")
    )


def stream_units(
    readings: DataFrame, grain: Grain, delay: str, measures: Measures = WEATHER
) -> DataFrame:
    """Streaming form of ``operators.anchored`` for hours, days and weeks.

    Write it in append mode for closed units only, each once, or in update mode for every
    change. ``delay`` bounds both lateness and the distance between repeated deliveries.
    """
    instant = wall_to_instant(F.col("measure_at"))
    just_before = instant - F.expr("INTERVAL '0.000001' SECOND")
    own = F.struct(instant.alias("_instant"), F.lit(False).alias("_closing"))
    closing = F.struct(just_before.alias("_instant"), F.lit(True).alias("_closing"))
    on_boundary = is_anchor(F.col("measure_at"), grain)
    counted = F.when(on_boundary, F.array(own, closing)).otherwise(F.array(own))
    # One watermark for both steps: a second one downstream is not allowed. The second count
    # of a boundary reading is not a repeat of a reading that really is just before it.
    unique = (
        readings.withColumn("_counted", F.explode(counted))
        .select("*", "_counted.*")
        .drop("_counted")
        .withWatermark("_instant", delay)
        .dropDuplicatesWithinWatermark(["station_id", "measure_at", "_closing"])
    )
    opening = ~F.col("_closing") & on_boundary
    states = unique.withColumn("_opening", opening).selectExpr(
        "station_id", "_instant", "_opening", "station_name", *measures.reading_state()
    )
    units = states.groupBy("station_id", _unit_window("_instant", grain).alias("_unit")).agg(
        *[F.expr(item) for item in measures.merged_state()],
        F.max("_opening").alias("_anchored"),
        F.max(F.when(F.col("_opening"), F.col("station_name"))).alias("station_name"),
    )
    anchored_units = units.filter("_anchored").withColumns(
        {
            "station_type": station_class("station_id"),
            "measure_at": instant_to_wall(F.col("_unit.start")),
        }
    )
    return anchored_units.selectExpr(
        "station_id", "station_name", "station_type", "measure_at", *measures.values(grain.suffix)
    )


def stream_day_states(readings: DataFrame, delay: str, measures: Measures = WEATHER) -> DataFrame:
    """Streaming form of ``operators.day_states.day_states``."""
    unique = (
        readings.withColumn("_instant", wall_to_instant(F.col("measure_at")))
        .withWatermark("_instant", delay)
        .dropDuplicatesWithinWatermark(["station_id", "_instant"])
    )
    on_midnight = F.col("measure_at") == midnight(F.col("measure_at"))
    states = unique.withColumn("_on_midnight", on_midnight).selectExpr(
        "station_id", "_instant", "_on_midnight", "station_name", *measures.reading_state()
    )
    days = states.groupBy("station_id", _unit_window("_instant", DAILY).alias("_unit")).agg(
        *day_aggregates(measures),
        F.max(F.when(F.col("_on_midnight"), F.col("station_name"))).alias("station_name"),
    )
    return days.withColumn(
        "measure_date", instant_to_wall(F.col("_unit.start")).cast("date")
    ).drop("_unit")
