"""The measurement models and how they are brought up to date."""

from __future__ import annotations

import datetime as dt
from calendar import monthrange
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wxengine.functions.calendar import GRAINS, Grain, Interval, interval, is_anchor
from wxengine.functions.cleaning import AGRICULTURAL, AUTOMATIC, MANNED
from wxengine.operators.anchored import anchored
from wxengine.operators.measures import WEATHER, Measures
from wxengine.operators.rolling import rolling
from wxengine.operators.select_suffix import publish
from wxengine.sources.marks import Mark, last_mark, log_of, write_mark
from wxengine.sources.tables import (
    append_after,
    at_literal,
    high_water_mark,
    newer_than,
    read_dates,
    read_table,
    replace_dates,
    table_exists,
    write_table,
)

AT = "measure_at"


def closed_windows(rolled: DataFrame, readings: DataFrame, grain: Grain, at: str = AT) -> DataFrame:
    """Rows whose window of this grain ends no later than the latest reading."""
    latest = readings.agg(F.max(at)).scalar()
    return rolled.filter(F.col(at) + interval(grain.interval) <= latest)


def artifact(rolled: DataFrame, grain: Grain) -> DataFrame:
    """Published aggregates of one grain out of the table of rolling columns."""
    return publish(rolled.filter(is_anchor(F.col(AT), grain)), grain)


def artifact_from_readings(
    readings: DataFrame, grain: Grain, measures: Measures = WEATHER
) -> DataFrame:
    """The same rows straight from the readings, without any rolling column."""
    return publish(anchored(readings, grain, measures), grain)


def by_class(readings: DataFrame) -> dict[str, DataFrame]:
    """Readings of manned, automatic and agricultural stations."""
    names = {"manned": MANNED, "automatic": AUTOMATIC, "agricultural": AGRICULTURAL}
    return {k: readings.filter(F.col("station_type") == v) for k, v in names.items()}


def longest(grains: Sequence[Grain]) -> Interval:
    """The longest of the grains' windows."""
    spans = [Interval.parse(grain.interval) for grain in grains]
    return max(spans, key=lambda span: span.longest_days * 86400 + span.seconds)


def window_end(grains: Sequence[Grain]) -> Column:
    return F.col(AT) + F.expr(longest(grains).sql)


def open_from(clock: dt.datetime, grains: Sequence[Grain]) -> dt.date:
    """A date before which every window had closed when the latest reading was ``clock``."""
    span = longest(grains)
    if not span.months:
        return (clock - dt.timedelta(seconds=span.seconds)).date()
    month = clock.year * 12 + clock.month - 1 - span.months
    year, month = month // 12, month % 12 + 1
    return dt.date(year, month, min(clock.day, monthrange(year, month)[1]))


def rebuild_rolling(
    readings: DataFrame,
    target: str,
    grains: Sequence[Grain] = GRAINS,
    measures: Measures = WEATHER,
    closed_at: dt.datetime | None = None,
) -> None:
    """Write the rolling table anew; with ``closed_at`` only rows whose longest window has ended."""
    rolled = rolling(readings, grains, measures)
    if closed_at is not None:
        rolled = rolled.filter(window_end(grains) <= at_literal(closed_at))
    write_table(rolled, target, "overwrite")


def append_rolling(
    readings: DataFrame,
    target: str,
    after: dt.datetime,
    grains: Sequence[Grain] = GRAINS,
    measures: Measures = WEATHER,
) -> dt.date:
    """Append the rows of ``readings``, all later than ``after``; returns the first date written."""
    first = after.date()
    append_after(rolling(readings, grains, measures), target, first, first, F.col(AT) <= at_literal(after))
    return first


def append_closed(
    readings: DataFrame,
    target: str,
    after: dt.datetime,
    clock: dt.datetime,
    grains: Sequence[Grain] = GRAINS,
    measures: Measures = WEATHER,
    days: DataFrame | None = None,
) -> dt.date:
    """Append the rows whose longest window has ended since ``after``; returns the first date.

    Rows do not close in the order of their times: windows of several days end on the last of
    a short month. ``readings`` hold all of the open dates, or, with the ``days`` between
    stored (``day_totals``), those on which the closing windows start and end.
    """
    first, end = open_from(after, grains), window_end(grains)
    closing = (end > at_literal(after)) & (end <= at_literal(clock))
    rolled = rolling(readings, grains, measures, days=days).filter(closing)
    append_after(rolled, target, first, after.date(), end <= at_literal(after))
    return first


def edge_dates(after: dt.datetime, clock: dt.datetime, grains: Sequence[Grain] = GRAINS) -> list[dt.date]:
    """Dates on which windows that have closed since ``after`` start or end."""
    first, last = open_from(after, grains), open_from(clock, grains)
    # Windows from later dates of a longer month close with those of its last day.
    starts = [first + dt.timedelta(days=i) for i in range((last - first).days + 4)]
    found = set(starts)
    for grain in grains:
        span = Interval.parse(grain.interval)
        for day in starts:
            if span.months:
                month = day.year * 12 + day.month - 1 + span.months
                year, month = month // 12, month % 12 + 1
                found.add(dt.date(year, month, min(day.day, monthrange(year, month)[1])))
            else:
                found.add(day + dt.timedelta(days=span.longest_days))
    return sorted(found)


def update_rolling(
    spark: SparkSession,
    readings: DataFrame,
    target: str,
    grains: Sequence[Grain] = GRAINS,
    measures: Measures = WEATHER,
    full_refresh: bool = False,
    only_closed: bool = False,
    number: int | None = None,
) -> None:
    """Append the rolling rows that are newer than everything stored, or rebuild.

    Windows look forward only, so a run needs no reading at or before the high-water mark;
    the filter goes below the windows and on to the scan. Late readings stay out, and rows
    stored with a window that was still open keep its value, until a full refresh.
    ``only_closed`` holds rows back until the longest window has ended.

    The mark comes from the log of runs, so a run that failed half-way counts for nothing.
    A run that is repeated under its ``number`` replaces what it wrote. A table that exists
    without rows takes nothing. The plan needs the run's readings several times, so they are
    computed once and stored beside the table until the next run.
    """
    log = log_of(target)
    last = last_mark(spark, log, before=number)
    rebuild = full_refresh or last is None
    if number is None:
        number = 0 if last is None else last.number + 1
    if rebuild or only_closed:
        readings = _stored_run(readings, target)
    clock = readings.agg(F.max(AT)).first()[0] if only_closed else None
    if rebuild:
        rebuild_rolling(readings, target, grains, measures, clock)
        mark = clock if only_closed else high_water_mark(spark, target)
    elif last.at is None:
        mark = None
    elif not only_closed:
        newer = _stored_run(newer_than(readings, last.at), target)
        append_rolling(newer, target, last.at, grains, measures)
        mark = max(last.at, high_water_mark(spark, target) or last.at)
    else:
        mark = max(last.at, clock or last.at)
        since = F.lit(dt.datetime.combine(open_from(last.at, grains), dt.time())).cast("timestamp_ntz")
        append_closed(readings.filter(F.col(AT) >= since), target, last.at, mark, grains, measures)
    write_mark(spark, log, Mark(number, mark))


def _stored_run(readings: DataFrame, target: str) -> DataFrame:
    """The readings of a run, read back from beside the table that they go to."""
    path = f"{target.rstrip('/')}.readings"
    readings.write.mode("overwrite").parquet(path)
    return readings.sparkSession.read.schema(readings.schema).parquet(path)


def update_artifact(
    spark: SparkSession,
    rolled: str,
    grain: Grain,
    target: str,
    full_refresh: bool = False,
    since: dt.date | None = None,
) -> None:
    """Append the newer rows of one published table, or rebuild it.

    ``rolled`` is where the rolling table is stored. Published rows are a selection of its
    rows, so dates from ``since`` on, without it from the newest published one, are written
    anew from its partitions of just those dates. A table that exists without rows takes
    nothing.
    """
    if full_refresh or not table_exists(spark, target):
        rows = read_table(spark, rolled)
        if rows is not None:
            write_table(artifact(rows, grain), target, "overwrite")
        return
    mark = high_water_mark(spark, target)
    if mark is None:
        return
    rows = read_dates(spark, rolled, since or mark.date())
    if rows is not None:
        replace_dates(artifact(rows, grain), target)
