"""Whole runs over a warehouse folder, callable from any scheduler."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from wxengine.functions.calendar import GRAINS
from wxengine.operators.dedup import READING_KEY, first_per_key, latest_per_key
from wxengine.operators.rolling import day_totals, rolling
from wxengine.operators.stations import existing_stations, revoked_stations
from wxengine.plans import staging
from wxengine.plans.measurements import (
    append_closed,
    append_rolling,
    artifact,
    edge_dates,
    open_from,
    rebuild_rolling,
    update_artifact,
    window_end,
)
from wxengine.plans.stations import GEO_ORDER, dimension, geo_seen
from wxengine.session import dropped_shuffles
from wxengine.sources.files import delete, exists
from wxengine.sources.landing import (
    MEASUREMENTS,
    RAIN_STATIONS,
    WEATHER_STATIONS,
    archive_path,
    read_archive,
    stream_archive,
)
from wxengine.sources.marks import Mark, last_mark, log_of, write_mark
from wxengine.sources.tables import (
    PARTITION,
    append_after,
    at_literal,
    high_water_mark,
    newer_than,
    read_dated,
    read_dates,
    read_table,
    replace_dates,
    write_table,
)
from wxengine.streaming.ingest import (
    append_rows,
    apply_batches,
    ingest,
    newest_version,
    store_version,
)

FEEDS = (MEASUREMENTS, WEATHER_STATIONS, RAIN_STATIONS)
_STATION = ("station_id",)


@dataclass(frozen=True)
class Layout:
    """Folders of the landing area and of the stored layers."""

    landing: str
    warehouse: str

    def landed(self, feed: str) -> str:
        return f"{self.landing}/{feed}"

    def checkpoint(self, feed: str) -> str:
        return f"{self.warehouse}/checkpoints/{feed}"

    @property
    def archive(self) -> str:
        return f"{self.warehouse}/archive"

    @property
    def readings(self) -> str:
        return f"{self.warehouse}/staging/readings"

    @property
    def run(self) -> str:
        """The readings of the run that goes on, or went last."""
        return f"{self.warehouse}/staging/run"

    @property
    def late(self) -> str:
        """Readings that came at or before the mark of their run, by run."""
        return f"{self.warehouse}/staging/late"

    @property
    def days(self) -> str:
        """Totals of station days, for windows that wait until they have closed."""
        return f"{self.warehouse}/intermediate/days"

    @property
    def rolling(self) -> str:
        return f"{self.warehouse}/intermediate/measurements"

    @property
    def geo(self) -> str:
        """Every distinct description of where a measuring station is."""
        return f"{self.warehouse}/staging/geography"

    @property
    def newest_geo(self) -> str:
        """The newest description of each measuring station, in versions."""
        return f"{self.warehouse}/staging/newest_geography"

    @property
    def stations(self) -> str:
        return f"{self.warehouse}/intermediate/stations"

    def artifact(self, name: str) -> str:
        return f"{self.warehouse}/artifacts/{name}"


def _landed(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def run_ingest(
    spark: SparkSession,
    layout: Layout,
    feeds: tuple[str, ...] = FEEDS,
    max_files_per_trigger: int | None = 10_000,
) -> None:
    """Archive what has newly landed in each feed; a feed that has not begun is passed over."""
    for feed in feeds:
        if not _landed(spark, layout.landed(feed)):
            continue
        query = ingest(
            spark,
            layout.landed(feed),
            layout.archive,
            feed,
            layout.checkpoint(feed),
            max_files_per_trigger,
        )
        query.awaitTermination()


def run_measurements(
    spark: SparkSession,
    layout: Layout,
    full_refresh: bool = False,
    only_closed: bool = False,
    max_files_per_trigger: int | None = None,
) -> None:
    """Bring the rolling table and the four published tables up to date.

    An incremental run is a stream over the archive: it takes the responses that no run has
    taken yet, so none is read twice. A full refresh reads the archive whole.
    ``only_closed`` holds rows back until their longest window has ended; a warehouse keeps to
    one of the two modes between full refreshes.
    """
    if full_refresh:
        last = last_mark(spark, log_of(layout.readings))
        readings = staging.measurements(read_archive(spark, layout.archive, MEASUREMENTS))
        with dropped_shuffles(spark):
            _rebuild(spark, layout, readings, -1 if last is None else last.number, only_closed)
        return
    if not exists(spark, archive_path(layout.archive, MEASUREMENTS)):
        return

    def apply(responses: DataFrame, number: int) -> None:
        apply_responses(spark, layout, responses, number, only_closed)

    responses = stream_archive(spark, layout.archive, MEASUREMENTS, max_files_per_trigger)
    apply_batches(responses, apply, layout.checkpoint("measurements")).awaitTermination()


def apply_responses(
    spark: SparkSession, layout: Layout, responses: DataFrame, number: int, only_closed: bool = False
) -> None:
    """Append what the responses of one numbered run add to the measurement tables.

    Readings after the mark of the run before are added, with their rolling columns and
    published rows; windows look forward, so no stored reading at or before the mark is
    needed. Readings at or before it are late, or repeats, and set aside for ``repair``. A run
    that is applied again under its number replaces what it wrote, with the same rows.
    """
    with dropped_shuffles(spark, responses.sparkSession):
        _apply(spark, layout, responses, number, only_closed)


def _apply(
    spark: SparkSession, layout: Layout, responses: DataFrame, number: int, only_closed: bool
) -> None:
    log = log_of(layout.readings)
    last = last_mark(spark, log, before=number)
    # JSON is taken apart once; everything below reads the typed readings.
    staging.measurements(responses).write.mode("overwrite").parquet(layout.run)
    found = spark.read.parquet(layout.run)
    if last is None:
        _rebuild(spark, layout, found, number, only_closed)
        return
    if last.at is None:  # a table that exists without rows takes nothing
        write_mark(spark, log, Mark(number, None))
        return
    stored_before = F.col("measure_at") <= at_literal(last.at)
    found.filter(stored_before).write.mode("overwrite").parquet(f"{layout.late}/run={number}")
    first = last.at.date()
    append_after(newer_than(found, last.at), layout.readings, first, first, stored_before)
    clock = high_water_mark(spark, layout.readings)
    if clock is not None and clock > last.at:
        since = _extend(spark, layout, last.at, clock, only_closed)
        for grain in GRAINS:
            update_artifact(spark, layout.rolling, grain, layout.artifact(grain.suffix), since=since)
    write_mark(spark, log, Mark(number, max(clock or last.at, last.at)))


def _extend(
    spark: SparkSession, layout: Layout, after: dt.datetime, clock: dt.datetime, only_closed: bool
) -> dt.date:
    """Append the rolling rows that a run adds; returns the first date that was written."""
    recent = read_dates(spark, layout.readings, after.date())
    if not only_closed:
        return append_rolling(newer_than(recent, after), layout.rolling, after)
    # A window's whole days come as totals, so only dates where windows start or end are read.
    replace_dates(day_totals(recent), layout.days, "_of")
    days = read_dates(spark, layout.days, open_from(after, GRAINS))
    edges = _of_dates(spark, layout.readings, edge_dates(after, clock))
    return append_closed(edges, layout.rolling, after, clock, days=days)


def _rebuild(
    spark: SparkSession, layout: Layout, readings: DataFrame, number: int, only_closed: bool
) -> None:
    """Write all measurement tables anew from these readings."""
    write_table(readings, layout.readings, "overwrite")
    clock = high_water_mark(spark, layout.readings)
    stored = read_table(spark, layout.readings)
    if stored is not None:
        rebuild_rolling(stored, layout.rolling, closed_at=clock if only_closed else None)
        if only_closed:
            write_table(day_totals(stored), layout.days, "overwrite", "_of")
    for grain in GRAINS:
        path = layout.artifact(grain.suffix)
        update_artifact(spark, layout.rolling, grain, path, full_refresh=True)
    delete(spark, layout.late)
    # Stored windows that had closed by this time hold all of their readings.
    write_mark(spark, log_of(layout.rolling), Mark(number, clock))
    write_mark(spark, log_of(layout.readings), Mark(number, clock))


def repair(spark: SparkSession, layout: Layout, only_closed: bool = False) -> None:
    """Bring late readings in, and windows up to date that were stored while open.

    Afterwards the tables are what a full refresh would write, but only dates whose rows can
    differ are written again: those up to a month before a late reading, and those with windows
    that had not closed at the last refresh or repair. Of the former only the stations with late
    readings are computed, from their readings of just the dates that their windows reach; the
    rows of the others are copied. Of one late reading delivered in several runs the first stays.

    The readings are written last, so a repair that failed starts over and finds the same.
    """
    with dropped_shuffles(spark):
        _repair(spark, layout, only_closed)


def _repair(spark: SparkSession, layout: Layout, only_closed: bool) -> None:
    last, complete = last_mark(spark, log_of(layout.readings)), last_mark(spark, log_of(layout.rolling))
    if last is None or last.at is None:
        return
    # Rows that wait until their windows have closed are never stored with an open one.
    opened = last.at.date() + dt.timedelta(days=1)
    if not only_closed and complete.at < last.at:
        opened = open_from(complete.at, GRAINS)
    late = _late_readings(spark, layout)
    date = F.col("measure_at").cast("date")
    # Windows of a month that reach a date start on one of the dates from a month before.
    starts = F.explode(F.sequence(F.add_months("_late", -1), F.col("_late")))
    touched = late.select("station_id", date.alias("_late")).distinct()
    touched = touched.select(F.col("station_id").alias("_station"), starts.alias("_date")).distinct()
    touched = touched.filter(F.col("_date") < F.lit(opened))
    dates, late_dates = _dates(touched, F.col("_date")), _dates(late, date)

    rows = []
    if opened <= last.at.date():
        readings = read_dates(spark, layout.readings, opened).unionByName(late.filter(date >= F.lit(opened)))
        rows.append(rolling(readings))
    if dates:
        reached = F.explode(F.sequence("_date", F.add_months("_date", 1)))
        needed = touched.select("_station", reached.alias("_date")).distinct()
        readings = _of_dates(spark, layout.readings, _dates(needed, F.col("_date"))).unionByName(late)
        stored = _of_dates(spark, layout.rolling, dates)
        rows += [
            _paired(rolling(_paired(readings, needed, "left_semi")), touched, "left_semi"),
            _paired(stored, touched, "left_anti"),
        ]
    if rows:
        repaired = rows[0]
        for more in rows[1:]:
            repaired = repaired.unionByName(more)
        if only_closed:
            repaired = repaired.filter(window_end(GRAINS) <= at_literal(last.at))
        replace_dates(repaired, layout.rolling)
        changed = F.col(PARTITION).isin(dates) | (F.col(PARTITION) >= F.lit(opened))
        for grain in GRAINS:
            published = read_dated(spark, layout.rolling).filter(changed).drop(PARTITION)
            replace_dates(artifact(published, grain), layout.artifact(grain.suffix))
    if late_dates:
        whole = _of_dates(spark, layout.readings, late_dates).unionByName(late)
        if only_closed:
            replace_dates(day_totals(whole), layout.days, "_of")
        replace_dates(whole, layout.readings)
    delete(spark, layout.late)
    write_mark(spark, log_of(layout.rolling), last)


def _late_readings(spark: SparkSession, layout: Layout) -> DataFrame:
    """Readings set aside by runs that are not stored, one per station and time."""
    aside = f"{layout.late}.new"
    nothing = read_table(spark, layout.readings).limit(0)
    if not exists(spark, layout.late):
        return nothing
    seen = first_per_key(spark.read.parquet(layout.late), READING_KEY, ["run"]).drop("run")
    dates = _dates(seen, F.col("measure_at").cast("date"))
    if not dates:
        return nothing
    stored = _of_dates(spark, layout.readings, dates).select(
        F.col("station_id").alias("_id"), F.col("measure_at").alias("_at")
    )
    same = F.col("station_id").eqNullSafe(F.col("_id")) & (F.col("measure_at") == F.col("_at"))
    seen.join(stored, same, "left_anti").write.mode("overwrite").parquet(aside)
    return spark.read.parquet(aside)


def _dates(rows: DataFrame, date) -> list[dt.date]:
    """The distinct dates, which are as many as the days that the readings span at most."""
    return sorted(r[0] for r in rows.select(date.alias("d")).distinct().collect() if r[0])


def _of_dates(spark: SparkSession, path: str, dates: list[dt.date]) -> DataFrame:
    """Stored rows of these dates; no other date is read."""
    return read_dated(spark, path).filter(F.col(PARTITION).isin(dates)).drop(PARTITION)


def _paired(rows: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    same = F.col("station_id").eqNullSafe(F.col("_station"))
    return rows.join(pairs, same & (F.col("measure_at").cast("date") == F.col("_date")), how)


def run_geography(spark: SparkSession, layout: Layout, latest_snapshot: bool = False) -> None:
    """Bring the stored geography of the measuring stations up to date.

    A stream takes the responses that it has not taken yet. It keeps each distinct description
    once, remembering those it has seen in its state store, or, with ``latest_snapshot``, the
    newest description of each station. Both are as small as the register of stations.
    """
    if not exists(spark, archive_path(layout.archive, MEASUREMENTS)):
        return
    responses = stream_archive(spark, layout.archive, MEASUREMENTS)
    if not latest_snapshot:
        distinct = staging.station_geo(responses)
        append_rows(distinct, layout.geo, layout.checkpoint("geography")).awaitTermination()
        return

    def store(seen: DataFrame, number: int) -> None:
        newest = latest_per_key(seen, _STATION, GEO_ORDER)
        store_version(spark, newest, number, layout.newest_geo, _STATION, GEO_ORDER)

    checkpoint = layout.checkpoint("newest_geography")
    apply_batches(geo_seen(responses), store, checkpoint).awaitTermination()


def _geography(spark: SparkSession, layout: Layout, latest_snapshot: bool) -> DataFrame:
    path = layout.newest_geo if latest_snapshot else layout.geo
    if not exists(spark, path):
        return staging.station_geo(read_archive(spark, layout.archive, MEASUREMENTS).limit(0))
    if latest_snapshot:
        return newest_version(spark, path, _STATION, GEO_ORDER).drop("_seen", "landed_file")
    return spark.read.parquet(path)


def run_stations(
    spark: SparkSession,
    layout: Layout,
    latest_snapshot: bool = False,
    append_lists: bool = False,
) -> None:
    """Rebuild the station dimension and the lists of existing and revoked stations.

    The geography is a stored state, so only responses that are new are taken apart for it.
    ``append_lists`` adds the lists to what is stored instead of replacing them, repeating
    every row on each run.
    """
    run_geography(spark, layout, latest_snapshot)
    rows = dimension(
        read_archive(spark, layout.archive, RAIN_STATIONS),
        read_archive(spark, layout.archive, WEATHER_STATIONS),
        _geography(spark, layout, latest_snapshot),
        latest_snapshot,
    )
    rows.write.mode("overwrite").parquet(layout.stations)
    stations = spark.read.parquet(layout.stations)
    mode = "append" if append_lists else "overwrite"
    existing_stations(stations).write.mode(mode).parquet(layout.artifact("existing_stations"))
    revoked_stations(stations).write.mode(mode).parquet(layout.artifact("revoked_stations"))


def full_refresh(spark: SparkSession, layout: Layout) -> None:
    """Archive what has landed, then rebuild everything from the archive."""
    run_ingest(spark, layout)
    run_stations(spark, layout)
    run_measurements(spark, layout, full_refresh=True)
