"""Typed staging models over landed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wxengine.functions.calendar import instant_to_wall
from wxengine.functions.cleaning import (
    empty_to_null,
    na_tag_to_null,
    negative_to_null,
    station_class,
)
from wxengine.operators.dedup import dedup_readings
from wxengine.operators.flatten import flatten

# Where each field of a response lies. Each entry is a column, the path of
# its field inside one station object, and the type it is cast to.
MEASUREMENT_FIELDS = (
    ("station_id", "$.StationId", "string"),
    ("air_temperature", "$.WeatherElement.AirTemperature", "double"),
    ("air_pressure", "$.WeatherElement.AirPressure", "double"),
    ("relative_humidity", "$.WeatherElement.RelativeHumidity", "double"),
    ("wind_speed", "$.WeatherElement.WindSpeed", "double"),
    ("wind_direction", "$.WeatherElement.WindDirection", "double"),
    ("wind_direction_gust", "$.WeatherElement.GustInfo.Occurred_at.WindDirection", "double"),
    ("peak_gust_speed", "$.WeatherElement.GustInfo.PeakGustSpeed", "double"),
    ("precipitation", "$.WeatherElement.Now.Precipitation", "double"),
    ("sunshine_duration_10min", "$.WeatherElement.SunshineDuration", "double"),
    ("uv_index", "$.WeatherElement.UVIndex", "double"),
    ("station_name", "$.StationName", "string"),
    ("visibility", "$.WeatherElement.VisibilityDescription", "string"),
    ("weather_status", "$.WeatherElement.Weather", "string"),
)
OBSERVED_AT = "$.ObsTime.DateTime"
GEO_FIELDS = (
    ("station_id", "$.StationId", "string"),
    ("station_latitude", "$.GeoInfo.Coordinates[0].StationLatitude", "double"),
    ("station_longitude", "$.GeoInfo.Coordinates[0].StationLongitude", "double"),
    ("station_altitude", "$.GeoInfo.StationAltitude", "double"),
    ("country_name", "$.GeoInfo.CountyName", "string"),
    ("country_code", "$.GeoInfo.CountyCode", "string"),
    ("town_name", "$.GeoInfo.TownName", "string"),
    ("town_code", "$.GeoInfo.TownCode", "string"),
    ("coordinate_format", "$.GeoInfo.Coordinates[0].CoordinateFormat", "string"),
)
WEATHER_STATION_FIELDS = (
    ("station_id", "$.StationID", "string"),
    ("original_station_id", "$.OriginalStationID", "string"),
    ("new_station_id", "$.NewStationID", "string"),
    ("station_status", "$.status", "string"),
    ("station_name", "$.StationName", "string"),
    ("station_name_en", "$.StationNameEN", "string"),
    ("country_name", "$.CountyName", "string"),
    ("location", "$.Location", "string"),
    ("notes", "$.Notes", "string"),
    ("station_altitude", "$.StationAltitude", "double"),
    ("station_longitude", "$.StationLongitude", "double"),
    ("station_latitude", "$.StationLatitude", "double"),
    ("start_at", "$.StationStartDate", "date"),
    ("end_at", "$.StationEndDate", "date"),
)
RAIN_STATION_FIELDS = (
    ("station_id", "$.Station_ID", "string"),
    ("city_code", "$.CITY_SN", "string"),
    ("town_code", "$.TOWN_SN", "string"),
    ("station_name", "$.Station_name", "string"),
    ("station_latitude", "$.Station_Latitude", "decimal(10,5)"),
    ("station_longitude", "$.Station_Longitude", "decimal(10,5)"),
    ("city_name", "$.CITY", "string"),
    ("town_name", "$.TOWN", "string"),
)
RECORDS = "$.records"
WEATHER_STATIONS = "$.records.data.stationStatus.station"
RAIN_STATIONS = "$.Data"
NEVER_NEGATIVE = (
    "air_temperature",
    "air_pressure",
    "relative_humidity",
    "wind_speed",
    "wind_direction",
    "wind_direction_gust",
    "peak_gust_speed",
    "precipitation",
    "sunshine_duration_10min",
    "uv_index",
)
MAY_BE_TAGGED = ("visibility", "weather_status")
EMPTY_MEANS_NULL = ("original_station_id", "new_station_id", "notes", "start_at", "end_at")


def field(item: Column | str, path: str, to: str, lenient: bool = False) -> Column:
    """One typed field. A value that does not fit is an error, or NULL when ``lenient``."""
    get = F.try_variant_get if lenient else F.variant_get
    item = F.col(item) if isinstance(item, str) else item
    return get(item, path, to)


def observed_at(
    item: Column | str, keep_wall_clock: bool = True, lenient: bool = False
) -> Column:
    """Observation time. Wall clock drops the offset of the text; otherwise UTC.

    Text that is no time is an error, or NULL when ``lenient``.
    """
    text = field(item, OBSERVED_AT, "string", lenient)
    kind = "timestamp_ntz" if keep_wall_clock else "timestamp"
    time = text.try_cast(kind) if lenient else text.cast(kind)
    return time if keep_wall_clock else instant_to_wall(time)


def stations_in_records(responses: DataFrame) -> DataFrame:
    """One row per station object of measurement responses, whatever keys hold them."""
    return flatten(flatten(responses, "value", RECORDS, item="group"), "group", item="item")


def parsed_measurements(responses: DataFrame, lenient: bool = False, keep_wall_clock: bool = True) -> DataFrame:
    """Readings as landed: typed and named, sentinels and repeats still in."""
    items = stations_in_records(responses)
    fields = [field("item", path, to, lenient).alias(c) for c, path, to in MEASUREMENT_FIELDS]
    kept = [c for c in items.columns if c != "item"]
    typed = items.select(
        *fields, observed_at("item", keep_wall_clock, lenient).alias("measure_at"), *kept
    )
    return typed.withColumn("station_type", station_class("station_id"))


# Columns of the cleaned readings, in order.
READING_COLUMNS = (
    "station_id",
    *NEVER_NEGATIVE,
    "station_name",
    *MAY_BE_TAGGED,
    "station_type",
    "measure_at",
)


def cleaned(readings: DataFrame, allow_negative: tuple[str, ...] = ()) -> DataFrame:
    """Sentinels to NULL.

    A negative number counts as missing in all ten measurements, real frost too;
    ``allow_negative`` names measurements to leave alone.
    """
    changes = {c: negative_to_null(c) for c in NEVER_NEGATIVE if c not in allow_negative}
    changes |= {c: na_tag_to_null(c) for c in MAY_BE_TAGGED}
    return readings.withColumns(changes)


def measurements(
    responses: DataFrame,
    allow_negative: tuple[str, ...] = (),
    lenient: bool = False,
    keep_wall_clock: bool = True,
) -> DataFrame:
    """Cleaned readings, one per station and time.

    Of repeated deliveries the one from the file that sorts first stays, and within a file
    the one with the smallest values.
    """
    readings = cleaned(parsed_measurements(responses, lenient, keep_wall_clock), allow_negative)
    payload = [c for c in READING_COLUMNS if c not in ("station_id", "measure_at")]
    unique = dedup_readings(readings, ["landed_file", *payload])
    return unique.select(*READING_COLUMNS)


def station_geo(responses: DataFrame, lenient: bool = False) -> DataFrame:
    """Distinct geographic descriptions of the measuring stations."""
    items = stations_in_records(responses)
    fields = [field("item", path, to, lenient).alias(c) for c, path, to in GEO_FIELDS]
    typed = items.select(*fields).withColumn("station_type", station_class("station_id"))
    return typed.distinct()


def weather_stations(responses: DataFrame, lenient: bool = False, keep_file: bool = False) -> DataFrame:
    """Register of manned and automatic weather stations, as landed."""
    items = flatten(responses, "value", WEATHER_STATIONS)
    columns = []
    for name, path, to in WEATHER_STATION_FIELDS:
        if name in EMPTY_MEANS_NULL:
            text = empty_to_null(field("item", path, "string", lenient))
            columns.append((text.try_cast(to) if lenient else text.cast(to)).alias(name))
        else:
            columns.append(field("item", path, to, lenient).alias(name))
    return items.select(*columns, *(["landed_file"] if keep_file else []))


def rain_stations(responses: DataFrame, lenient: bool = False, keep_file: bool = False) -> DataFrame:
    """Register of rain stations, as landed."""
    items = flatten(responses, "value", RAIN_STATIONS)
    fields = [field("item", path, to, lenient).alias(c) for c, path, to in RAIN_STATION_FIELDS]
    return items.select(*fields, *(["landed_file"] if keep_file else []))
