"""The station dimension out of landed registers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wxengine.operators.dedup import latest_per_key
from wxengine.operators.stations import all_stations
from wxengine.plans import staging
from wxengine.sources.landing import arrived_at


def station_dimension(
    rain_responses: DataFrame,
    weather_responses: DataFrame,
    measurement_responses: DataFrame,
    latest_snapshot: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """All stations from the three kinds of responses.

    By default every landed copy of a register takes part, so copies multiply in the join.
    ``latest_snapshot`` keeps the newest landed row per station in each register and the
    geography of the newest response first. Values that do not fit their types are errors,
    or NULL when ``lenient``.
    """
    if latest_snapshot:
        geo = newest_geo(geo_seen(measurement_responses, lenient))
    else:
        geo = staging.station_geo(measurement_responses, lenient)
    return dimension(rain_responses, weather_responses, geo, latest_snapshot, lenient)


def dimension(
    rain_responses: DataFrame,
    weather_responses: DataFrame,
    geo: DataFrame,
    latest_snapshot: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """The same with the geography of the measuring stations given, for example stored."""
    if not latest_snapshot:
        return all_stations(
            staging.rain_stations(rain_responses, lenient),
            staging.weather_stations(weather_responses, lenient),
            geo,
        )
    rain = _latest(staging.rain_stations(rain_responses, lenient, keep_file=True))
    weather = _latest(staging.weather_stations(weather_responses, lenient, keep_file=True))
    return all_stations(rain, weather, geo, unique_keys=True)


def _latest(register: DataFrame) -> DataFrame:
    register = register.withColumn("_arrived", arrived_at("landed_file"))
    payload = [c for c in register.columns if c not in ("station_id", "_arrived", "landed_file")]
    order = ("_arrived", "landed_file", *payload)
    return latest_per_key(register, ("station_id",), order).drop("_arrived", "landed_file")


# Which of a station's descriptions is the newest.
GEO_ORDER = ("_seen", "landed_file", *(c for c, _, _ in staging.GEO_FIELDS if c != "station_id"))


def geo_seen(responses: DataFrame, lenient: bool = False) -> DataFrame:
    """Geography of every reading, with its time as ``_seen`` and its file."""
    items = staging.stations_in_records(responses)
    fields = [staging.field("item", path, to, lenient).alias(c) for c, path, to in staging.GEO_FIELDS]
    return items.select(
        *fields, "landed_file", staging.observed_at("item", lenient=lenient).alias("_seen")
    )


def newest_geo(seen: DataFrame) -> DataFrame:
    """The newest description of each station."""
    return latest_per_key(seen, ("station_id",), GEO_ORDER).drop("_seen", "landed_file")
