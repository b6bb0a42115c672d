"""Station days as mergeable states, and calendar units built from them.

One pass over the readings gives a state per station and day; days, weeks and months then
come from this much smaller table. A unit is closed at both ends, so next to a day's state
its midnight reading is kept on its own: it is also the last reading of the unit before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wxengine.functions.calendar import HOURLY, Grain, interval, midnight, trunc_to
from wxengine.functions.cleaning import station_class
from wxengine.operators.anchored import with_anchor
from wxengine.operators.measures import WEATHER, Measures

AT_MIDNIGHT = "midnight_"


def day_aggregates(measures: Measures) -> list[Column]:
    """Aggregates of one station day over reading states, where ``_on_midnight`` is set."""
    items = [
        *measures.merged_state(),
        *measures.merged_state(AT_MIDNIGHT, where="_on_midnight"),
        "max(_on_midnight) AS has_midnight",
    ]
    return [F.expr(item) for item in items]


def day_states(
    readings: DataFrame,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
) -> DataFrame:
    """State of each station day of deduplicated readings."""
    dated = readings.withColumns(
        {
            "measure_date": F.col(at).cast("date"),
            "_on_midnight": F.col(at) == midnight(F.col(at)),
        }
    )
    states = dated.selectExpr(
        f"`{station}`", "measure_date", "_on_midnight", *measures.reading_state()
    )
    days = states.groupBy("measure_date", station).agg(*day_aggregates(measures))
    named = dated.filter("_on_midnight").select(
        F.col("measure_date").alias("_date"), F.col(station).alias("_station"), "station_name"
    )
    same = (F.col("measure_date") == F.col("_date")) & F.col(station).eqNullSafe(F.col("_station"))
    return days.join(named, same, "left").drop("_date", "_station")


def units_from_days(
    days: DataFrame,
    grain: Grain,
    measures: Measures = WEATHER,
    station: str = "station_id",
    at: str = "measure_at",
) -> DataFrame:
    """The same rows as ``anchored`` over the readings, for days, weeks or months."""
    if grain == HOURLY:
        raise ValueError("hours cannot be built from days")
    day = F.col("measure_date").cast("timestamp_ntz")
    start = trunc_to(day, grain)
    whole = F.struct(start.alias(at), F.lit(False).alias("_closing"))
    closing = F.struct((start - interval(grain.interval)).alias(at), F.lit(True).alias("_closing"))
    parts = F.when(
        (day == start) & F.col("has_midnight"), F.array(whole, closing)
    ).otherwise(F.array(whole))

    placed = days.select(
        "*", day.alias("_midnight"), F.explode(parts).alias("_part")
    ).select("*", "_part.*")
    opening = ~F.col("_closing") & (F.col("_midnight") == F.col(at)) & F.col("has_midnight")
    opened = placed.withColumn("_opening", opening)
    states = opened.selectExpr(
        f"`{station}`",
        f"`{at}`",
        *[
            f"IF(_closing, `{AT_MIDNIGHT}{name}`, `{name}`) AS `{name}`"
            for name in measures.state_columns
        ],
        "_opening",
    )
    units = states.groupBy(at, station).agg(
        *[F.expr(item) for item in measures.merged_state()],
        F.max("_opening").alias("_anchored"),
    )
    anchored_units = units.filter("_anchored").withColumn("station_type", station_class(station))
    anchors = days.filter(F.col("has_midnight") & (day == start)).select(
        start.alias(at), station, "station_name"
    )
    anchored_units = with_anchor(anchored_units, anchors, station, at)
    return anchored_units.selectExpr(
        f"`{station}`", "station_name", "station_type", f"`{at}`", *measures.values(grain.suffix)
    )
