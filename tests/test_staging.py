"""Staging models over hand-written responses."""

import datetime as dt
import json
from decimal import Decimal

import payloads
import pytest
from pyspark.sql import functions as F

from wxengine.plans import staging


def responses(spark, *values, files=None):
    files = files or [f"f{i}" for i in range(len(values))]
    texts = [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values]
    rows = spark.createDataFrame(list(zip(texts, files)), "json STRING, landed_file STRING")
    return rows.select(F.parse_json("json").alias("value"), "landed_file")


@pytest.mark.parametrize(
    "text", ["{}", '{"records": 5}', '{"records": null}', '{"records": {}}', '{"records": {"Station": []}}']
)
def test_nothing_to_flatten_gives_no_row(spark, text):
    assert staging.measurements(responses(spark, text)).count() == 0


def test_any_key_holds_stations(spark):
    value = {"records": {"A": [payloads.station("1")], "B": [payloads.station("2")]}}
    rows = staging.measurements(responses(spark, value)).collect()
    assert sorted(r.station_id for r in rows) == ["1", "2"]


def test_measurement_columns_and_sentinels(spark):
    readings = staging.measurements(responses(spark, payloads.measurements(payloads.station())))
    assert tuple(readings.columns) == staging.READING_COLUMNS
    row = readings.first()
    assert row.measure_at == dt.datetime(2024, 8, 1, 10)
    assert (row.air_temperature, row.precipitation) == (31.2, 0.5)
    assert (row.uv_index, row.peak_gust_speed, row.wind_direction_gust) == (None, None, None)
    assert (row.weather_status, row.visibility) == (None, "16-20")
    assert row.station_type == "有人站"


def test_observation_time_in_utc(spark):
    raw = responses(spark, payloads.measurements(payloads.station()))
    assert staging.measurements(raw, keep_wall_clock=False).first().measure_at == dt.datetime(2024, 8, 1, 2)


def test_frost_is_lost_unless_allowed(spark):
    raw = responses(spark, payloads.measurements(payloads.station(temperature="-3.0")))
    assert staging.measurements(raw).first().air_temperature is None
    kept = staging.measurements(raw, allow_negative=("air_temperature",)).first()
    assert kept.air_temperature == -3.0


def test_text_in_a_number_is_an_error_or_null(spark):
    raw = responses(spark, payloads.measurements(payloads.station(temperature="X")))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        staging.measurements(raw).collect()
    assert staging.measurements(raw, lenient=True).first().air_temperature is None


def test_repeated_delivery_keeps_the_first_file(spark):
    first = payloads.measurements(payloads.station(temperature="1.0"))
    again = payloads.measurements(payloads.station(temperature="0.5"))
    rows = staging.measurements(responses(spark, again, first, files=["b", "a"])).collect()
    assert [r.air_temperature for r in rows] == [1.0]


def test_geography(spark):
    moved = payloads.station(coordinates=(("f1", "26", "122"),))
    raw = responses(
        spark,
        payloads.measurements(payloads.station(), payloads.station(at="2024-08-01T10:10:00+08:00")),
        payloads.measurements(moved),
    )
    geo = staging.station_geo(raw)
    assert geo.columns[0] == "station_id" and len(geo.columns) == 10
    found = {(r.station_latitude, r.station_longitude, r.coordinate_format) for r in geo.collect()}
    assert found == {(25.01, 121.5, "f1"), (26.0, 122.0, "f1")}


def test_weather_register(spark):
    value = payloads.weather_register(
        payloads.weather_station(), payloads.weather_station("C0X", OriginalStationID="C0Y", StationEndDate="2020-01-02")
    )
    rows = {r.station_id: r for r in staging.weather_stations(responses(spark, value)).collect()}
    assert (rows["466920"].notes, rows["466920"].original_station_id, rows["466920"].end_at) == (None,) * 3
    assert rows["466920"].start_at == dt.date(1896, 1, 1)
    assert (rows["C0X"].original_station_id, rows["C0X"].end_at) == ("C0Y", dt.date(2020, 1, 2))


def test_rain_register(spark):
    row = staging.rain_stations(responses(spark, payloads.rain_register(payloads.rain_station()))).first()
    assert row.station_latitude == Decimal("24.97712")
    assert (row.city_code, row.city_name, row.town_code) == ("65", "rc", "6500100")


def test_lenient_reading_covers_the_time(spark):
    raw = responses(spark, payloads.measurements(payloads.station(at="bad"), payloads.station()))
    assert staging.measurements(raw, lenient=True).filter("measure_at is null").count() == 1
