"""The registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wxengine.catalog import inputs
from wxengine.functions import ahead
from wxengine.functions.calendar import DAILY, GRAINS, HOURLY, MONTHLY, WEEKLY
from wxengine.functions.cleaning import (
    empty_to_null,
    na_tag_to_null,
    negative_to_null,
    station_class,
)
from wxengine.operators import stations
from wxengine.operators.day_states import day_states, units_from_days
from wxengine.operators.dedup import latest_per_key
from wxengine.operators.flatten import flatten
from wxengine.operators.measures import WEATHER, Measures
from wxengine.operators.mode import mode_per_unit, rolling_mode, swept_mode
from wxengine.operators.rolling import rolling
from wxengine.operators.rolling_length import rolling_length
from wxengine.operators.select_suffix import publish
from wxengine.plans import jobs, measurements as models, staging
from wxengine.session import shared_dir
from wxengine.sources.landing import (
    MEASUREMENTS,
    RAIN_STATIONS,
    WEATHER_STATIONS,
    compact_landing,
    read_archive,
    stream_archive,
    stream_landing,
)
from wxengine.sources.tables import read_table
from wxengine.streaming import aggregate, ingest

# The first incremental run sees readings up to here, the second one all of them.
CUT_OFF = "2024-02-10 00:00:00"
# How late a reading may come to a stream, and to the one that loses what is later.
DELAY, SHORT_DELAY = "2 days", "1 hour"
FILES_PER_TRIGGER = 64
LANDED_COLUMNS = ("station_id", *staging.NEVER_NEGATIVE, "station_name", "visibility",
                  "weather_status", "station_type", "measure_at")


# ---------------------------------------------------------------- sources and JSON


def scan_json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = inputs.landing(spark, sf_dir, "scan")
    return staging.parsed_measurements(responses).select(*LANDED_COLUMNS)


def landing_compaction(spark, sf_dir):
    responses = inputs.landing(spark, sf_dir, "compaction")
    archive = shared_dir(spark, "archive")
    compact_landing(responses, archive, MEASUREMENTS)
    stored = read_archive(spark, archive, MEASUREMENTS)
    items = flatten(
        flatten(stored.select("feed", "ingest_date", "value"), "value", staging.RECORDS, "group"),
        "group",
    )
    return items.select(
        "feed",
        "ingest_date",
        staging.field("item", "$.StationId", "string").alias("station_id"),
        staging.observed_at("item").alias("measure_at"),
    )


def flatten_object(spark, sf_dir):
    key = F.col("c_custkey")
    pair = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    json = (
        F.when(key % 7 == 0, F.lit("{}"))
        .when(key % 11 == 0, F.lit('{"records": 5}'))
        .when(key % 13 == 0, F.lit('{"records": {}}'))
        .otherwise(F.to_json(F.struct(pair.alias("records"))))
    )
    rows = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", F.parse_json(json).alias("value")
    )
    values = flatten(rows, "value", staging.RECORDS, key="object_key")
    return values.select(
        "c_custkey",
        "object_key",
        staging.field("item", "$", "string").alias("object_value"),
    )


def flatten_nested_array(spark, sf_dir):
    items = inputs.table(spark, sf_dir, "customer").select(
        F.struct("c_custkey", "c_name", "c_acctbal").alias("item")
    )
    responses = inputs.parsed(inputs.as_responses(items, inputs.in_station_record))
    return staging.stations_in_records(responses).select(
        staging.field("item", "$.c_custkey", "bigint").alias("c_custkey"),
        staging.field("item", "$.c_name", "string").alias("c_name"),
        staging.field("item", "$.c_acctbal", "double").alias("c_acctbal"),
    )


def flatten_deep_path(spark, sf_dir):
    items = inputs.weather_register_items(spark, sf_dir)
    return staging.weather_stations(inputs.parsed(inputs.as_responses(items, inputs.in_register)))


def flatten_top_array(spark, sf_dir):
    items = inputs.rain_register_items(spark, sf_dir)
    return staging.rain_stations(inputs.parsed(inputs.as_responses(items, inputs.in_data)))


def json_extract(spark, sf_dir):
    items = inputs.measurement_items(inputs.raw_readings(spark, sf_dir)).select("item")
    responses = inputs.parsed(inputs.as_responses(items, inputs.in_station_record))
    return staging.parsed_measurements(responses).select(*LANDED_COLUMNS)


def json_array_index(spark, sf_dir):
    items = inputs.geo_items(spark, sf_dir).select("item")
    responses = inputs.parsed(inputs.as_responses(items, inputs.in_station_record))
    found = staging.stations_in_records(responses)
    return found.select(
        *[staging.field("item", path, to).alias(c) for c, path, to in staging.GEO_FIELDS]
    )


def json_casts(spark, sf_dir):
    key = F.col("o_orderkey")
    digits = F.lpad(F.pmod(key * 7919, F.lit(1000000)).cast("string"), 6, "0")
    text = F.struct(
        F.col("o_totalprice").cast("string").alias("price"),
        F.concat((key % 180).cast("string"), F.lit("."), digits).alias("longitude"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.concat(F.col("o_orderdate").cast("string"), F.lit("+08:00")).alias("at"),
        F.when(key % 10 == 0, "X").otherwise(key.cast("string")).alias("broken"),
    )
    rows = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.parse_json(F.to_json(text)).alias("item")
    )
    return rows.select(
        "o_orderkey",
        staging.field("item", "$.price", "double").alias("price"),
        staging.field("item", "$.longitude", "decimal(10,5)").alias("longitude"),
        staging.field("item", "$.day", "date").alias("order_day"),
        staging.field("item", "$.at", "string").cast("timestamp_ntz").alias("ordered_at"),
        staging.field("item", "$.broken", "double", lenient=True).alias("lenient"),
    )


# ---------------------------------------------------------------- cleaning


def negative_values(spark, sf_dir):
    raw = inputs.raw_readings(spark, sf_dir)
    return raw.select(
        "event_id", *[negative_to_null(c).alias(c) for c in staging.NEVER_NEGATIVE]
    )


def sentinel_values(spark, sf_dir):
    raw = inputs.raw_readings(spark, sf_dir)
    return raw.select("event_id", *[na_tag_to_null(c).alias(c) for c in staging.MAY_BE_TAGGED])


def empty_values(spark, sf_dir):
    size = F.col("p_size")
    text = F.when(size % 5 == 0, "").otherwise(F.col("p_type"))
    day = F.when(size % 4 == 0, "").otherwise(
        F.concat(F.lit("2024-03-"), F.lpad((size % 28 + 1).cast("string"), 2, "0"))
    )
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey",
        empty_to_null(text).alias("type_or_null"),
        empty_to_null(day).cast("date").alias("day_or_null"),
    )


def station_type(spark, sf_dir):
    key = F.col("o_custkey")
    station = F.when(key % 9 != 0, inputs.station_id(key))
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", station.alias("station_id"))
    return orders.withColumn("station_type", station_class("station_id"))


def dedup_readings(spark, sf_dir):
    return inputs.readings(spark, sf_dir)


# ---------------------------------------------------------------- rolling


def _rolling(grains, measures: Measures = WEATHER, all_columns: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings = inputs.readings(spark, sf_dir)
        if not all_columns:
            readings = readings.select("station_id", "measure_at", *measures.columns)
        rolled = rolling(readings, grains, measures)
        return rolled if all_columns else rolled.drop(*measures.columns)

    return query


def rolling_mode_station(spark, sf_dir):
    readings = inputs.readings(spark, sf_dir).select("station_id", "measure_at", "wind_direction")
    return rolling_mode(readings, "wind_direction", "1 hour")


def mode_bucket_global(spark, sf_dir):
    return mode_per_unit(inputs.readings(spark, sf_dir), "wind_direction", HOURLY)


def _swept_mode(length, station="station_id"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings = inputs.readings(spark, sf_dir).select("station_id", "measure_at", "wind_direction")
        return swept_mode(readings, "wind_direction", length, station)

    return query


def _rolling_length(length, suffix):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        readings = inputs.readings(spark, sf_dir)
        readings = readings.select("station_id", "measure_at", *WEATHER.columns)
        return rolling_length(readings, length, suffix).drop(*WEATHER.columns)

    return query


def window_functions_digits(spark, sf_dir):
    """Maximum and mode of values with many decimals, rounded once."""
    fine = inputs.readings(spark, sf_dir).select(
        "station_id", "measure_at", ((F.col("uv_index") + 1) / 200 - 0.00004).alias("v")
    )
    return fine.select(
        "station_id",
        "measure_at",
        ahead.find_max_in_interval("v", "measure_at", "1 hour").alias("largest"),
        ahead.find_mode_in_interval("v", "measure_at", "1 hour").alias("mode"),
    )


def rolling_fine_digits(spark, sf_dir):
    """All windows over values with six decimals."""
    readings = inputs.readings(spark, sf_dir).select(
        "station_id", "measure_at", F.round(F.col("air_temperature") / 7, 6).alias("air_temperature")
    )
    measures = Measures(*[("air_temperature",)] * 3)
    return rolling(readings, GRAINS, measures).drop("air_temperature")


def window_functions_hour(spark, sf_dir):
    """The single-column window functions, over an hour."""
    return inputs.readings(spark, sf_dir).select(
        "station_id",
        "measure_at",
        ahead.averaged_by_datetime("air_temperature", "measure_at", "1 hour").alias("average"),
        ahead.sum_over_datetime("precipitation", "measure_at", "1 hour").alias("total"),
        ahead.find_max_in_interval("wind_speed", "measure_at", "1 hour").alias("largest"),
    )


def _dynamic_select(grain):
    """One grain's columns out of all 52, picked by their suffix."""
    return lambda spark, sf_dir: models.artifact(
        rolling(inputs.readings(spark, sf_dir), GRAINS), grain
    )


def _artifact(grain):
    return lambda spark, sf_dir: models.artifact_from_readings(
        inputs.readings(spark, sf_dir), grain
    )


def _from_days(grain):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = day_states(inputs.readings(spark, sf_dir))
        return publish(units_from_days(days, grain), grain)

    return query


def readings_by_class(spark, sf_dir):
    views = models.by_class(inputs.readings(spark, sf_dir))
    labelled = [
        rows.select(F.lit(name).alias("view_name"), "station_id", "measure_at", "station_type")
        for name, rows in views.items()
    ]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


# ---------------------------------------------------------------- stations


def _geo(spark, sf_dir):
    return inputs.geo_rows(spark, sf_dir).select(*inputs.GEO_COLUMNS)


def station_full_outer(spark, sf_dir):
    return stations.rain_with_weather(
        inputs.rain_table(spark, sf_dir), inputs.weather_table(spark, sf_dir), unique_keys=True
    )


def station_join_3way(spark, sf_dir):
    return stations.all_stations(
        inputs.rain_table(spark, sf_dir),
        inputs.weather_table(spark, sf_dir),
        _geo(spark, sf_dir).distinct(),
    )


def station_fanout(spark, sf_dir):
    rain, weather = inputs.rain_table(spark, sf_dir), inputs.weather_table(spark, sf_dir)
    geo = _geo(spark, sf_dir)
    return stations.all_stations(rain.unionAll(rain), weather.unionAll(weather), geo)


def station_latest(spark, sf_dir):
    geo = inputs.geo_rows(spark, sf_dir)
    newest = latest_per_key(geo, ("station_id",), ("o_orderdate", "o_orderkey"))
    return stations.all_stations(
        inputs.rain_table(spark, sf_dir),
        inputs.weather_table(spark, sf_dir),
        newest.select(*inputs.GEO_COLUMNS),
        unique_keys=True,
    )


def existing_stations(spark, sf_dir):
    return stations.existing_stations(station_join_3way(spark, sf_dir))


def revoked_stations(spark, sf_dir):
    return stations.revoked_stations(station_join_3way(spark, sf_dir))


def geo_distinct(spark, sf_dir):
    items = inputs.geo_items(spark, sf_dir).select("item")
    responses = inputs.parsed(inputs.as_responses(items, inputs.in_station_record))
    return staging.station_geo(responses)


# ---------------------------------------------------------------- incremental

def _until_cut_off(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("measure_at") <= F.lit(CUT_OFF).cast("timestamp_ntz"))


def _on_time(raw: DataFrame) -> DataFrame:
    """What the first run sees when every tenth reading is late."""
    return _until_cut_off(raw).filter("event_id % 10 <> 3")


def _run(spark, target, raw, **options):
    readings = inputs.unique_readings(raw)
    models.update_rolling(spark, readings, target, **options)


def incremental_append(spark, sf_dir):
    target = shared_dir(spark, "incremental")
    raw = inputs.raw_readings(spark, sf_dir)
    _run(spark, target, _until_cut_off(raw))
    _run(spark, target, raw)
    return read_table(spark, target)


def _artifact_append(grain):
    """A published table, appended to after each of two runs of the rolling table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rolled, target = shared_dir(spark, "rolled"), shared_dir(spark, "published")
        raw = inputs.raw_readings(spark, sf_dir)
        for seen in (_until_cut_off(raw), raw):
            _run(spark, rolled, seen)
            models.update_artifact(spark, rolled, grain, target)
        published = read_table(spark, target)
        # A table without rows has no schema either.
        return models.artifact(read_table(spark, rolled), grain).limit(0) if published is None else published

    return query


def late_data_drop(spark, sf_dir):
    target = shared_dir(spark, "late")
    raw = inputs.raw_readings(spark, sf_dir)
    _run(spark, target, _on_time(raw))
    _run(spark, target, raw)
    return read_table(spark, target)


def full_refresh(spark, sf_dir):
    target = shared_dir(spark, "refresh")
    raw = inputs.raw_readings(spark, sf_dir)
    _run(spark, target, _on_time(raw))
    _run(spark, target, raw)
    _run(spark, target, raw, full_refresh=True)
    return read_table(spark, target)


def closed_windows_only(spark, sf_dir):
    readings = inputs.readings(spark, sf_dir)
    return models.closed_windows(rolling(readings, GRAINS), readings, MONTHLY)


# ---------------------------------------------------------------- streaming


def _finish(query) -> None:
    query.awaitTermination()


def stream_file_ingest(spark, sf_dir):
    landing = inputs.landed_measurements(spark, sf_dir, "arrivals")
    archive, checkpoint = shared_dir(spark, "archive"), shared_dir(spark, "checkpoint")
    _finish(
        ingest.ingest(spark, landing, archive, MEASUREMENTS, checkpoint, FILES_PER_TRIGGER)
    )
    responses = read_archive(spark, archive, MEASUREMENTS)
    return staging.parsed_measurements(responses.select("value", "ingest_date")).select(
        "ingest_date", *LANDED_COLUMNS
    )


def _in_steps(spark, sf_dir, label, start, late_within=inputs.LATE_WITHIN):
    """Land the series step by step, and run a stream over what has landed after each."""
    landing, checkpoint = shared_dir(spark, label), shared_dir(spark, "checkpoint")
    rows = inputs.stored_arrivals(spark, sf_dir, late_within)
    for step in range(inputs.STEPS):
        inputs.land_step(spark, rows, step, landing)
        responses = stream_landing(spark, landing)
        _finish(start(staging.cleaned(staging.parsed_measurements(responses)), checkpoint))


def stream_dedup(spark, sf_dir):
    target = shared_dir(spark, "unique")

    def start(readings, checkpoint):
        unique = aggregate.dedup_stream(readings.select(*staging.READING_COLUMNS), DELAY)
        return ingest.append_rows(unique, target, checkpoint)

    _in_steps(spark, sf_dir, "repeats", start)
    return spark.read.parquet(target)


def _streamed_units(grain):
    """The aggregates of a grain as a stream that stores every change of a unit."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, keys = shared_dir(spark, "units"), ("station_id", "measure_at")

        def start(readings, checkpoint):
            units = aggregate.stream_units(readings, grain, DELAY)
            return ingest.write_versions(units, target, checkpoint, keys, fold_after=2)

        _in_steps(spark, sf_dir, grain.suffix, start)
        return publish(ingest.newest_version(spark, target, keys), grain)

    return query


def stream_closed_hours(spark, sf_dir):
    """Each hour once, as it closes; readings that come later than the delay are lost."""
    target = shared_dir(spark, "closed")

    def start(readings, checkpoint):
        return ingest.append_rows(aggregate.stream_units(readings, HOURLY, SHORT_DELAY), target, checkpoint)

    _in_steps(spark, sf_dir, "closing", start, late_within=None)
    return publish(spark.read.parquet(target), HOURLY)


def stream_days_to_months(spark, sf_dir):
    target, keys = shared_dir(spark, "days"), ("station_id", "measure_date")

    def start(readings, checkpoint):
        days = aggregate.stream_day_states(readings, DELAY)
        return ingest.write_versions(days, target, checkpoint, keys, fold_after=2)

    _in_steps(spark, sf_dir, "daily", start)
    return publish(units_from_days(ingest.newest_version(spark, target, keys), MONTHLY), MONTHLY)


# ---------------------------------------------------------------- whole runs


def _layout(spark) -> jobs.Layout:
    return jobs.Layout(shared_dir(spark, "landing"), shared_dir(spark, "warehouse"))


def _runs(spark, sf_dir, run) -> jobs.Layout:
    """A warehouse after a run for each step of a series with late readings and repeats."""
    layout = _layout(spark)
    rows = inputs.stored_arrivals(spark, sf_dir)
    for step in range(inputs.STEPS):
        inputs.land_step(spark, rows, step, layout.landed(MEASUREMENTS))
        jobs.run_ingest(spark, layout, (MEASUREMENTS,))
        run(layout)
    return layout


def job_measurements(spark, sf_dir):
    """Landed files to rolling columns, a run a step; every batch is delivered twice."""

    def run(layout):
        def twice(responses, number):
            for _ in range(2):
                jobs.apply_responses(spark, layout, responses, number)

        responses = stream_archive(spark, layout.archive, MEASUREMENTS)
        _finish(ingest.apply_batches(responses, twice, layout.checkpoint("measurements")))

    return read_table(spark, _runs(spark, sf_dir, run).rolling)


def job_artifacts(spark, sf_dir):
    """The four published tables after a run for each step."""
    layout = _runs(spark, sf_dir, lambda layout: jobs.run_measurements(spark, layout))
    published = [(grain, read_table(spark, layout.artifact(grain.suffix))) for grain in GRAINS]
    tables = [rows.withColumn("grain", F.lit(grain.suffix)) for grain, rows in published if rows is not None]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows


def job_closed_windows(spark, sf_dir):
    """Rows that each left a run when their longest window had closed."""

    def run(layout):
        jobs.run_measurements(spark, layout, only_closed=True)

    return read_table(spark, _runs(spark, sf_dir, run).rolling)


def job_repair(spark, sf_dir):
    """Runs with late readings, and then a repair of the dates that they concern."""
    layout = _runs(spark, sf_dir, lambda layout: jobs.run_measurements(spark, layout))
    jobs.repair(spark, layout)
    return read_table(spark, layout.rolling)


def _landed_stations(spark, sf_dir) -> jobs.Layout:
    """All three feeds landed, the registers twice, the second time without some stations."""
    layout = _layout(spark)
    geo = inputs.geo_items(spark, sf_dir)
    feeds = {
        RAIN_STATIONS: (inputs.rain_register_items(spark, sf_dir), inputs.in_data),
        WEATHER_STATIONS: (inputs.weather_register_items(spark, sf_dir), inputs.in_register),
    }
    for feed, (items, wrap) in feeds.items():
        for day, landed in enumerate((items, items.filter(inputs.LANDED_AGAIN[feed])), start=1):
            arrival = F.lit(f"2024-05-{day:02d}_12_01")
            responses = inputs.as_responses(landed.withColumn("arrival", arrival), wrap, "arrival")
            responses.write.mode("append").partitionBy("arrival").text(layout.landed(feed))
    for day in (1, 2):
        # Seen on the day of the order, so that the newest order tells where a station is.
        part = geo.filter(F.pmod("o_orderkey", F.lit(2)) == day - 1)
        seen = part.select(inputs.seen_item().alias("item"), F.lit(f"2024-05-{day:02d}_00_03").alias("arrival"))
        responses = inputs.as_responses(seen, inputs.in_station_record, "arrival")
        responses.write.mode("append").partitionBy("arrival").text(layout.landed(MEASUREMENTS))
        jobs.run_ingest(spark, layout)
        jobs.run_geography(spark, layout)
        jobs.run_geography(spark, layout, latest_snapshot=True)
    return layout


def job_stations(spark, sf_dir):
    """The station dimension out of landed files, every landed copy in it."""
    layout = _landed_stations(spark, sf_dir)
    jobs.run_stations(spark, layout)
    return spark.read.parquet(layout.stations)


def job_stations_latest(spark, sf_dir):
    """The station dimension with the newest landed row of each station."""
    layout = _landed_stations(spark, sf_dir)
    jobs.run_stations(spark, layout, latest_snapshot=True)
    return spark.read.parquet(layout.stations)


def job_station_lists(spark, sf_dir):
    """Existing and revoked stations, appended again by a second run."""
    layout = _landed_stations(spark, sf_dir)
    for _ in range(2):
        jobs.run_stations(spark, layout, latest_snapshot=True, append_lists=True)
    lists = [
        spark.read.parquet(layout.artifact(f"{name}_stations")).withColumn("list", F.lit(name))
        for name in ("existing", "revoked")
    ]
    return lists[0].unionByName(lists[1])


QUERIES = {
    "scan_json_landing": scan_json_landing,
    "landing_compaction": landing_compaction,
    "flatten_object": flatten_object,
    "flatten_nested_array": flatten_nested_array,
    "flatten_deep_path": flatten_deep_path,
    "flatten_top_array": flatten_top_array,
    "json_extract": json_extract,
    "json_array_index": json_array_index,
    "json_casts": json_casts,
    "negative_to_null": negative_values,
    "sentinel_to_null": sentinel_values,
    "empty_to_null": empty_values,
    "station_type": station_type,
    "dedup_readings": dedup_readings,
    "rolling_avg": _rolling([DAILY], Measures(averaged=WEATHER.averaged)),
    "rolling_sum": _rolling([DAILY], Measures(summed=WEATHER.summed)),
    "rolling_max": _rolling([DAILY], Measures(maxed=WEATHER.maxed)),
    "rolling_mode_station": rolling_mode_station,
    "rolling_mode_day": _swept_mode("1 day"),
    "rolling_mode_week": _swept_mode("1 week"),
    "rolling_mode_month": _swept_mode("1 month"),
    "rolling_mode_all_stations": _swept_mode("1 hour", station=None),
    "rolling_mode_all_stations_week": _swept_mode("1 week", station=None),
    "mode_bucket_global": mode_bucket_global,
    "rolling_90_minutes": _rolling_length("90 minutes", "long"),
    "rolling_36_hours": _rolling_length("36 hours", "long"),
    "rolling_3_months": _rolling_length("3 months", "quarterly"),
    "rolling_hour": _rolling([HOURLY]),
    "rolling_day": _rolling([DAILY]),
    "rolling_week": _rolling([WEEKLY]),
    "rolling_month": _rolling([MONTHLY]),
    "rolling_all": _rolling(GRAINS, all_columns=True),
    "rolling_fine_digits": rolling_fine_digits,
    "window_functions_hour": window_functions_hour,
    "window_functions_digits": window_functions_digits,
    "dynamic_select_hourly": _dynamic_select(HOURLY),
    "dynamic_select_daily": _dynamic_select(DAILY),
    "dynamic_select_weekly": _dynamic_select(WEEKLY),
    "dynamic_select_monthly": _dynamic_select(MONTHLY),
    "agg_hourly": _artifact(HOURLY),
    "agg_daily": _artifact(DAILY),
    "agg_weekly": _artifact(WEEKLY),
    "agg_monthly": _artifact(MONTHLY),
    "agg_daily_from_days": _from_days(DAILY),
    "agg_weekly_from_days": _from_days(WEEKLY),
    "agg_monthly_from_days": _from_days(MONTHLY),
    "readings_by_class": readings_by_class,
    "station_full_outer": station_full_outer,
    "station_join_3way": station_join_3way,
    "station_fanout": station_fanout,
    "station_latest": station_latest,
    "existing_stations": existing_stations,
    "revoked_stations": revoked_stations,
    "geo_distinct": geo_distinct,
    "incremental_append": incremental_append,
    "artifact_append": _artifact_append(HOURLY),
    "artifact_append_daily": _artifact_append(DAILY),
    "artifact_append_weekly": _artifact_append(WEEKLY),
    "artifact_append_monthly": _artifact_append(MONTHLY),
    "late_data_drop": late_data_drop,
    "full_refresh": full_refresh,
    "closed_windows_only": closed_windows_only,
    "stream_file_ingest": stream_file_ingest,
    "stream_dedup": stream_dedup,
    "stream_agg_hourly": _streamed_units(HOURLY),
    "stream_agg_daily": _streamed_units(DAILY),
    "stream_closed_hours": stream_closed_hours,
    "stream_agg_weekly": _streamed_units(WEEKLY),
    "stream_days_to_months": stream_days_to_months,
    "job_measurements": job_measurements,
    "job_artifacts": job_artifacts,
    "job_closed_windows": job_closed_windows,
    "job_repair": job_repair,
    "job_stations": job_stations,
    "job_stations_latest": job_stations_latest,
    "job_station_lists": job_station_lists,
}
