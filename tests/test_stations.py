"""The station dimension over hand-written registers."""

import json

import payloads
import pytest
from pyspark.sql import functions as F

from wxengine.operators import stations
from wxengine.plans import staging
from wxengine.plans.stations import station_dimension


def responses(spark, *values):
    rows = [
        (json.dumps(value, ensure_ascii=False), f"weather-2024-08-{day:02d}_12_01.json")
        for day, value in enumerate(values, start=1)
    ]
    frame = spark.createDataFrame(rows, "json STRING, landed_file STRING")
    return frame.select(F.parse_json("json").alias("value"), "landed_file")


RAIN = payloads.rain_register(
    payloads.rain_station("C0A520"),
    payloads.rain_station("466920", Station_name="rain name"),
    payloads.rain_station(None, Station_name="nameless rain"),
)
WEATHER = payloads.weather_register(
    payloads.weather_station("466920"),
    payloads.weather_station("C1X", "已撤銷"),
    payloads.weather_station(None, StationName="nameless weather"),
)
SEEN = payloads.measurements(payloads.station("466920"), payloads.station("466999"))


@pytest.mark.parametrize("latest", [False, True])
def test_all_three_inputs(spark, latest):
    found = station_dimension(
        responses(spark, RAIN), responses(spark, WEATHER), responses(spark, SEEN), latest
    )
    assert tuple(found.columns) == tuple(stations.STATION_COLUMNS)
    rows = found.collect()
    assert len(rows) == 6
    by_id = {r.station_id: r for r in rows if r.station_id}

    both = by_id["466920"]
    assert (both.station_name, both.country_name, both.country_code) == ("rain name", "rc", "65")
    assert both.station_longitude_wgs87 == 121.5 and both.station_latitude_tw97 == 25.01
    assert both.station_type == "有人站"

    assert by_id["C0A520"].station_latitude_wgs87 == 24.97712
    assert by_id["C1X"].station_type == "自動站"

    unknown = by_id["466999"]
    assert (unknown.station_type, unknown.station_name) == ("農業雨量站", None)
    assert (unknown.town_name, unknown.country_code) == ("t", "63")

    assert sorted(r.station_name for r in rows if r.station_id is None) == [
        "nameless rain",
        "nameless weather",
    ]
    assert [r.station_id for r in stations.revoked_stations(found).collect()] == ["C1X"]
    assert stations.existing_stations(found).count() == 2


def test_copies_multiply_unless_latest(spark):
    newer = payloads.weather_register(payloads.weather_station("466920", StationName="newer"))
    rain = responses(spark, RAIN, RAIN)
    weather = responses(spark, WEATHER, WEATHER, newer)
    seen = responses(spark, SEEN)

    copies = station_dimension(rain, weather, seen).filter("station_id = '466920'")
    assert copies.count() == 2 * 3

    latest = station_dimension(rain, weather, seen, latest_snapshot=True)
    row = latest.filter("station_id = '466920'").collect()
    assert len(row) == 1 and row[0].station_name == "rain name"
    assert latest.filter("station_id = 'C1X'").count() == 1


def test_counted_join_equals_full_outer(spark, monkeypatch):
    """Copies on both sides, keys without a partner and without a value."""
    monkeypatch.setattr(stations, "COPIES_AT_ONCE", 2)
    rain = staging.rain_stations(responses(spark, RAIN)).unionByName(
        staging.rain_stations(responses(spark, RAIN)).limit(1)
    )
    weather = staging.weather_stations(responses(spark, WEATHER, WEATHER, WEATHER))
    left = rain.withColumnsRenamed({c: f"r_{c}" for c in rain.columns})
    right = weather.withColumnsRenamed({c: f"w_{c}" for c in weather.columns})
    joined = left.join(right, F.col("r_station_id") == F.col("w_station_id"), "full_outer")
    native = joined.select(
        *[F.coalesce(*parts).alias(name) for name, parts in stations.REGISTER_COLUMNS.items()]
    )
    counted = stations.rain_with_weather(rain, weather)
    assert counted.exceptAll(native).count() == 0 and native.exceptAll(counted).count() == 0
    assert counted.count() == native.count() > 3 * weather.select("station_id").distinct().count()


def test_a_row_with_many_copies_is_dealt_in_parts(spark):
    rows = spark.createDataFrame([("a", 25_001), ("b", 1), ("c", 10_000)], "station_id string, copies bigint")
    found = stations._copied(rows, "copies").groupBy("station_id").count()
    assert {tuple(r) for r in found.collect()} == {("a", 25_001), ("b", 1), ("c", 10_000)}
