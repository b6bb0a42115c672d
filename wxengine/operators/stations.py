"""Joining the station registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wxengine.functions.cleaning import station_class

# The states of a station.
EXISTING = "現存測站"
REVOKED = "已撤銷"

# The columns of the joined registers and of the station dimension, each
# with the inputs it comes from; the first that is not NULL wins. The inputs are r (rain
# register), w (weather register), s (both joined) and g (geography of measurements).
REGISTER_COLUMNS = {
    "station_id": ("r_station_id", "w_station_id"),
    "original_station_id": ("w_original_station_id",),
    "new_station_id": ("w_new_station_id",),
    "city_code": ("r_city_code",),
    "town_code": ("r_town_code",),
    "station_status": ("w_station_status",),
    "station_name": ("r_station_name", "w_station_name"),
    "station_name_en": ("w_station_name_en",),
    "city_name": ("r_city_name", "w_country_name"),
    "town_name": ("r_town_name",),
    "location": ("w_location",),
    "notes": ("w_notes",),
    "station_altitude": ("w_station_altitude",),
    "station_longitude": ("w_station_longitude", "r_station_longitude"),
    "station_latitude": ("w_station_latitude", "r_station_latitude"),
    "start_at": ("w_start_at",),
    "end_at": ("w_end_at",),
}
STATION_COLUMNS = {
    "station_id": ("s_station_id", "g_station_id"),
    "original_station_id": ("s_original_station_id",),
    "new_station_id": ("s_new_station_id",),
    "country_code": ("s_city_code", "g_country_code"),
    "town_code": ("s_town_code", "g_town_code"),
    "station_status": ("s_station_status",),
    "station_name": ("s_station_name",),
    "station_name_en": ("s_station_name_en",),
    "country_name": ("s_city_name", "g_country_name"),
    "town_name": ("s_town_name", "g_town_name"),
    "location": ("s_location",),
    "notes": ("s_notes",),
    "tw97_coordinate_format": ("g_coordinate_format",),
    "station_type": ("s_station_type",),
    "station_altitude": ("s_station_altitude",),
    "station_longitude_wgs87": ("s_station_longitude",),
    "station_latitude_wgs87": ("s_station_latitude",),
    "station_longitude_tw97": ("g_station_longitude",),
    "station_latitude_tw97": ("g_station_latitude",),
    "start_at": ("s_start_at",),
    "end_at": ("s_end_at",),
}


def _prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.withColumnsRenamed({c: prefix + c for c in rows.columns})


def _from_inputs(joined: DataFrame, columns: dict[str, tuple[str, ...]]) -> DataFrame:
    return joined.select(*[F.coalesce(*inputs).alias(name) for name, inputs in columns.items()])


# So many copies of a row are written by one task at a time.
COPIES_AT_ONCE = 10_000


def _counted(rows: DataFrame, prefix: str, unique_keys: bool) -> DataFrame:
    """Distinct rows under prefixed names, with the number of their copies."""
    named = _prefixed(rows, prefix)
    if unique_keys:
        return named.withColumn(f"{prefix}copies", F.lit(1).cast("bigint"))
    return named.groupBy(*named.columns).agg(F.count("*").alias(f"{prefix}copies"))


def _copied(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as often as ``copies`` says.

    A row with many copies is dealt into parts of bounded size, which are then spread over
    tasks, so that a key with a third of all copies is written by as many tasks.
    """
    parts = F.expr(f"sequence(0L, (`{copies}` - 1) DIV {COPIES_AT_ONCE})")
    dealt = rows.withColumn("_part", F.explode(parts)).hint("rebalance")
    size = f"least({COPIES_AT_ONCE}L, `{copies}` - _part * {COPIES_AT_ONCE})"
    again = dealt.withColumn("_copy", F.explode(F.expr(f"array_repeat(0, CAST({size} AS INT))")))
    return again.drop("_part", "_copy", copies)


def _registers(rain: DataFrame, weather: DataFrame, unique_keys: bool) -> DataFrame:
    """Full outer join of distinct rows of the two registers, with their number of copies."""
    left, right = _counted(rain, "r_", unique_keys), _counted(weather, "w_", unique_keys)
    joined = left.join(right, F.col("r_station_id") == F.col("w_station_id"), "full_outer")
    copies = F.coalesce("r_copies", F.lit(1)) * F.coalesce("w_copies", F.lit(1))
    return _from_inputs(joined.withColumn("copies", copies), REGISTER_COLUMNS | {"copies": ("copies",)})


def rain_with_weather(rain: DataFrame, weather: DataFrame, unique_keys: bool = False) -> DataFrame:
    """Full outer join of the two registers.

    Registers that were landed k and m times give k*m rows per station. Copies are counted
    before the join, which then sees each distinct row once, and written out after it.
    ``unique_keys`` promises one row per station on either side.
    """
    joined = _registers(rain, weather, unique_keys)
    return joined.drop("copies") if unique_keys else _copied(joined, "copies")


def all_stations(
    rain: DataFrame, weather: DataFrame, geo: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """The station dimension: both registers and the stations seen measuring.

    The class of a station known only from measurements is that of a missing id, whatever
    its prefix, and it has neither name nor altitude.
    """
    registers = _prefixed(_registers(rain, weather, unique_keys), "s_")
    seen = _counted(geo, "g_", unique_keys)
    joined = registers.join(seen, F.col("s_station_id") == F.col("g_station_id"), "full_outer")
    joined = joined.withColumn("s_station_type", station_class("s_station_id"))
    copies = F.coalesce("s_copies", F.lit(1)) * F.coalesce("g_copies", F.lit(1))
    joined = joined.withColumn("copies", copies)
    stations = _from_inputs(joined, STATION_COLUMNS | {"copies": ("copies",)})
    return stations.drop("copies") if unique_keys else _copied(stations, "copies")


def existing_stations(stations: DataFrame) -> DataFrame:
    return stations.filter(F.col("station_status") == EXISTING)


def revoked_stations(stations: DataFrame) -> DataFrame:
    return stations.filter(F.col("station_status") == REVOKED)
