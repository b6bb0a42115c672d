"""Weather-shaped inputs derived from the driver's tables.

The tables hold no weather data. Readings come from ``events``: 32 users make a station,
the time axis is stretched fourfold from 28 November 2023 so that series cross several
month ends, and times are floored to ten minutes, which also makes repeated readings.
Registers come from ``customer``, ``supplier`` and ``orders``, which share integer keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wxengine.functions.cleaning import station_class
from wxengine.operators.dedup import READING_KEY, dedup_readings, first_per_key
from wxengine.operators.stations import EXISTING, REVOKED
from wxengine.plans.staging import READING_COLUMNS, cleaned
from wxengine.sources.landing import RAIN_STATIONS, WEATHER_STATIONS, read_landing
from wxengine.session import dropped_shuffles, shared_dir

STATIONS_PER_RESPONSE = 50
# A compressed file is read by one task, so its size is bounded.
RESPONSES_PER_FILE = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_id(number: Column) -> Column:
    """Class prefix by the number's remainder, then eight digits."""
    prefixes = F.array(*[F.lit(p) for p in ("46", "C0", "C1", "72")])
    prefix = F.element_at(prefixes, (number % 4 + 1).cast("int"))
    return F.concat(prefix, F.lpad(number.cast("string"), 8, "0"))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as landed, with repeats and sentinels, and ``event_id`` to tell them apart."""
    stretched = (
        "TIMESTAMP_NTZ '2023-11-28 00:00:00' + (ts - TIMESTAMP_NTZ '2024-01-01 00:00:00') * 4"
    )
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "value",
        "shiftright(user_id, 5) AS no",
        f"{stretched} AS at",
        "from_json(props, 'k DOUBLE').k AS k",
    )
    readings = events.select("*", station_id(F.col("no")).alias("station_id")).selectExpr(
        "event_id",
        "station_id",
        "IF(event_type = 'error', -99D, value) AS air_temperature",
        "k + 900 AS air_pressure",
        "CAST(event_id % 101 AS DOUBLE) AS relative_humidity",
        "CAST(event_id % 173 AS DOUBLE) / 10D AS wind_speed",
        "k * 10 % 360 AS wind_direction",
        "CAST(event_id * 7 % 360 AS DOUBLE) AS wind_direction_gust",
        "(CAST(event_id % 173 AS DOUBLE) + k) / 10D AS peak_gust_speed",
        "CASE event_type WHEN 'purchase' THEN k / 2D WHEN 'signup' THEN -99D ELSE 0D END"
        " AS precipitation",
        "IF(event_type = 'view', NULL, CAST(event_id % 11 AS DOUBLE) / 10D)"
        " AS sunshine_duration_10min",
        "CAST(event_id % 12 AS DOUBLE) AS uv_index",
        "concat('Station ', no, ' ', event_type) AS station_name",
        "IF(event_type = 'error', '-99', event_type) AS visibility",
        "IF(event_type = 'click', '-99', event_type) AS weather_status",
        "CAST(CAST(at AS DATE) AS TIMESTAMP_NTZ)"
        " + make_dt_interval(0, hour(at), minute(at) - minute(at) % 10) AS measure_at",
    )
    return readings.withColumn("station_type", station_class("station_id"))


def unique_readings(raw: DataFrame) -> DataFrame:
    return dedup_readings(cleaned(raw), ["event_id"]).select(*READING_COLUMNS)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned readings, one per station and time."""
    return unique_readings(raw_readings(spark, sf_dir))


# ---------------------------------------------------------------- responses


def as_responses(items: DataFrame, wrap: Callable[[Column], Column], *by: str) -> DataFrame:
    """Pack ``item`` structs into JSON responses of a bounded number of stations.

    Rows are numbered within their partition, so a response never holds more than
    ``STATIONS_PER_RESPONSE`` rows, however the data are distributed.
    """
    response = F.call_function("div", F.monotonically_increasing_id(), F.lit(STATIONS_PER_RESPONSE))
    packed = items.withColumn("_response", response).groupBy(*by, "_response")
    stations = packed.agg(F.collect_list("item").alias("_items"))
    return stations.select(*by, F.to_json(wrap(F.col("_items"))).alias("json"))


def parsed(responses: DataFrame) -> DataFrame:
    """Responses as a VARIANT column, without the round trip through files."""
    return responses.select(F.parse_json("json").alias("value"))


def in_station_record(items: Column) -> Column:
    return F.struct(F.create_map(F.lit("Station"), items).alias("records"))


def in_register(items: Column) -> Column:
    status = F.struct(items.alias("station"))
    data = F.struct(status.alias("stationStatus"))
    return F.struct(F.struct(data.alias("data")).alias("records"))


def in_data(items: Column) -> Column:
    return F.struct(items.alias("Data"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def measurement_items(raw: DataFrame) -> DataFrame:
    """Station objects of measurement responses, and the week of their arrival."""
    gust = F.struct(
        _text("peak_gust_speed").alias("PeakGustSpeed"),
        F.struct(_text("wind_direction_gust").alias("WindDirection")).alias("Occurred_at"),
    )
    weather = F.struct(
        F.col("weather_status").alias("Weather"),
        F.col("visibility").alias("VisibilityDescription"),
        _text("air_temperature").alias("AirTemperature"),
        _text("air_pressure").alias("AirPressure"),
        _text("relative_humidity").alias("RelativeHumidity"),
        _text("wind_speed").alias("WindSpeed"),
        _text("wind_direction").alias("WindDirection"),
        _text("sunshine_duration_10min").alias("SunshineDuration"),
        _text("uv_index").alias("UVIndex"),
        F.struct(_text("precipitation").alias("Precipitation")).alias("Now"),
        gust.alias("GustInfo"),
    )
    observed = F.concat(F.replace(_text("measure_at"), F.lit(" "), F.lit("T")), F.lit("+08:00"))
    item = F.struct(
        F.col("station_id").alias("StationId"),
        F.col("station_name").alias("StationName"),
        F.struct(observed.alias("DateTime")).alias("ObsTime"),
        weather.alias("WeatherElement"),
    )
    week = F.trunc(F.col("measure_at").cast("date"), "week").cast("string")
    return raw.select(item.alias("item"), F.concat(week, F.lit("_00_03")).alias("arrival"))


def land(spark: SparkSession, responses: DataFrame, label: str) -> str:
    """Write responses as landed JSON files under their arrival; returns the folder."""
    folder = shared_dir(spark, label)
    responses.hint("rebalance", "arrival").write.partitionBy("arrival").text(folder)
    return folder


def landed_measurements(spark: SparkSession, sf_dir: str, label: str) -> str:
    items = measurement_items(raw_readings(spark, sf_dir))
    return land(spark, as_responses(items, in_station_record, "arrival"), label)


# Landings of a series in steps: those before each of these times, and the rest.
CUTS = ("2023-12-25 00:00:00", "2024-01-22 00:00:00")
STEPS = len(CUTS) + 1
# Every tenth reading of a step comes with the next one: all of them, or those of the step's
# last hours, which a stream with a longer delay still takes.
LATE = "event_id % 10 = 3"
LATE_WITHIN = "1 day"


def arrivals(raw: DataFrame, late_within: str | None = None) -> DataFrame:
    """One raw reading per station and time with the ``step`` that it lands in, and repeats.

    Every fifth reading is delivered again, with the same values, in the same step, and in
    the next one too if it is of the last hours of its own. ``late_within`` keeps lateness
    within that length.
    """
    cuts = [f"TIMESTAMP_NTZ '{cut}'" for cut in CUTS]
    step = " + ".join(f"IF(measure_at >= {cut}, 1, 0)" for cut in cuts)
    near = " OR ".join(f"(measure_at < {c} AND measure_at >= {c} - INTERVAL {LATE_WITHIN})" for c in cuts)
    late = f"({LATE}) AND step < {len(cuts)}" + (f" AND ({near})" if late_within else "")
    unique = first_per_key(raw, READING_KEY, ["event_id"]).withColumn("step", F.expr(step))
    once = unique.withColumn("step", F.expr(f"IF({late}, step + 1, step)"))
    again = F.expr(
        f"IF(event_id % 5 <> 0, array(step), IF(step < {len(cuts)} AND ({near}),"
        " array(step, step, step + 1), array(step, step)))"
    )
    return once.withColumn("step", F.explode(again))


def stored_arrivals(spark: SparkSession, sf_dir: str, late_within: str | None = None) -> DataFrame:
    """``arrivals`` of the series, written once: every step takes its rows from there."""
    path = shared_dir(spark, "arrivals")
    with dropped_shuffles(spark):
        arrivals(raw_readings(spark, sf_dir), late_within).write.parquet(path)
    return spark.read.parquet(path)


def land_step(spark: SparkSession, rows: DataFrame, step: int, folder: str) -> None:
    """Add one step of ``arrivals`` to a landing folder, as files that arrived in that order.

    The files are compressed, as JSON repeats every name in every station object.
    """
    items = measurement_items(rows.filter(F.col("step") == step)).select("item")
    arrival = F.lit(f"2024-05-{step + 1:02d}_00_03")
    responses = as_responses(items.withColumn("arrival", arrival), in_station_record, "arrival")
    files = responses.hint("rebalance", "arrival").write.mode("append").partitionBy("arrival")
    with dropped_shuffles(spark):
        files.option("maxRecordsPerFile", RESPONSES_PER_FILE).text(folder, compression="gzip")


def landing(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return read_landing(spark, landed_measurements(spark, sf_dir, label))


# ---------------------------------------------------------------- registers


def weather_register_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    revoked = F.col("s_acctbal") < 0
    return table(spark, sf_dir, "supplier").select(
        F.struct(
            station_id(key).alias("StationID"),
            F.when(revoked, REVOKED).otherwise(EXISTING).alias("status"),
            F.col("s_name").alias("StationName"),
            F.upper("s_name").alias("StationNameEN"),
            F.concat(F.lit("C"), _text("s_nationkey")).alias("CountyName"),
            F.concat(F.lit("L"), _text("s_nationkey")).alias("Location"),
            F.when(key % 3 == 0, "").otherwise(F.lit("note")).alias("Notes"),
            F.when(key % 5 == 0, station_id(key + 1)).otherwise("").alias("OriginalStationID"),
            F.when(revoked, station_id(key + 2)).otherwise("").alias("NewStationID"),
            F.col("s_acctbal").alias("StationAltitude"),
            (key % 180).cast("double").alias("StationLongitude"),
            (key % 90).cast("double").alias("StationLatitude"),
            F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int"))
            .cast("string")
            .alias("StationStartDate"),
            F.when(revoked, "2020-06-30").otherwise("").alias("StationEndDate"),
        ).alias("item")
    )


def rain_register_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    digits = F.lpad(F.pmod(key * 7919, F.lit(1000000)).cast("string"), 6, "0")
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.struct(
                # Shifted, so that each register has stations that the others lack.
                station_id(key + 5).alias("Station_ID"),
                F.col("c_name").alias("Station_name"),
                F.concat((key % 90).cast("string"), F.lit("."), digits).alias("Station_Latitude"),
                F.concat((key % 180).cast("string"), F.lit("."), digits).alias("Station_Longitude"),
                _text("c_nationkey").alias("CITY_SN"),
                F.concat(F.lit("City "), _text("c_nationkey")).alias("CITY"),
                F.substring("c_mktsegment", 1, 3).alias("TOWN_SN"),
                F.col("c_mktsegment").alias("TOWN"),
            ).alias("item")
        )
    )


def geo_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geography of the stations that orders mention, one object per order."""
    key = F.col("o_custkey")

    def point(system: str, shift: float) -> Column:
        return F.struct(
            F.lit(system).alias("CoordinateFormat"),
            ((key % 90).cast("double") + shift).cast("string").alias("StationLatitude"),
            ((key % 180).cast("double") + shift).cast("string").alias("StationLongitude"),
        )

    geo = F.struct(
        F.array(point("TWD67", 0.5), point("WGS84", 0.25)).alias("Coordinates"),
        (key % 4000).cast("string").alias("StationAltitude"),
        F.concat(F.lit("County "), (key % 23).cast("string")).alias("CountyName"),
        (key % 23).cast("string").alias("CountyCode"),
        F.concat(F.lit("Town "), F.col("o_orderstatus")).alias("TownName"),
        F.col("o_orderstatus").alias("TownCode"),
    )
    return table(spark, sf_dir, "orders").select(
        F.struct(station_id(key).alias("StationId"), geo.alias("GeoInfo")).alias("item"),
        "o_orderdate",
        "o_orderkey",
    )


# The stations of each register that are landed a second time.
LANDED_AGAIN = {RAIN_STATIONS: "item.CITY_SN <> '3'", WEATHER_STATIONS: "item.Location <> 'L3'"}


def seen_item() -> Column:
    """A station object of ``geo_items`` with the day of its order as observation time."""
    day = F.col("o_orderdate").cast("date").cast("string")
    # Orders of one day are told apart by their keys.
    fraction = F.lpad(F.pmod("o_orderkey", F.lit(10**6)).cast("string"), 6, "0")
    at = F.concat(day, F.lit("T00:00:00."), fraction)
    return F.struct(
        F.col("item.StationId").alias("StationId"),
        F.col("item.GeoInfo").alias("GeoInfo"),
        F.struct(at.alias("DateTime")).alias("ObsTime"),
    )


def rain_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rain register as its staging model would show it."""
    item = rain_register_items(spark, sf_dir).select("item.*")
    return item.select(
        F.col("Station_ID").alias("station_id"),
        F.col("CITY_SN").alias("city_code"),
        F.col("TOWN_SN").alias("town_code"),
        F.col("Station_name").alias("station_name"),
        F.col("Station_Latitude").cast("decimal(10,5)").alias("station_latitude"),
        F.col("Station_Longitude").cast("decimal(10,5)").alias("station_longitude"),
        F.col("CITY").alias("city_name"),
        F.col("TOWN").alias("town_name"),
    )


def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = weather_register_items(spark, sf_dir).select("item.*")
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    return item.select(
        F.col("StationID").alias("station_id"),
        empty("OriginalStationID").alias("original_station_id"),
        empty("NewStationID").alias("new_station_id"),
        F.col("status").alias("station_status"),
        F.col("StationName").alias("station_name"),
        F.col("StationNameEN").alias("station_name_en"),
        F.col("CountyName").alias("country_name"),
        F.col("Location").alias("location"),
        empty("Notes").alias("notes"),
        F.col("StationAltitude").alias("station_altitude"),
        F.col("StationLongitude").alias("station_longitude"),
        F.col("StationLatitude").alias("station_latitude"),
        empty("StationStartDate").cast("date").alias("start_at"),
        empty("StationEndDate").cast("date").alias("end_at"),
    )


def geo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geography, one row per order, with the order's date and key as landing order."""
    item = geo_items(spark, sf_dir)
    point = F.col("item.GeoInfo.Coordinates")[0]
    return item.select(
        F.col("item.StationId").alias("station_id"),
        point["StationLatitude"].cast("double").alias("station_latitude"),
        point["StationLongitude"].cast("double").alias("station_longitude"),
        F.col("item.GeoInfo.StationAltitude").cast("double").alias("station_altitude"),
        F.col("item.GeoInfo.CountyName").alias("country_name"),
        F.col("item.GeoInfo.CountyCode").alias("country_code"),
        F.col("item.GeoInfo.TownName").alias("town_name"),
        F.col("item.GeoInfo.TownCode").alias("town_code"),
        point["CoordinateFormat"].alias("coordinate_format"),
        "o_orderdate",
        "o_orderkey",
    )


GEO_COLUMNS = (
    "station_id",
    "station_latitude",
    "station_longitude",
    "station_altitude",
    "country_name",
    "country_code",
    "town_name",
    "town_code",
    "coordinate_format",
)
