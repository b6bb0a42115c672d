"""Rolling and anchored aggregates against self-joins, on irregular series."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from wxengine.functions import ahead
from wxengine.functions.calendar import DAILY, GRAINS, HOURLY, MONTHLY, WEEKLY
from wxengine.operators.anchored import anchored
from wxengine.operators.day_states import day_states, units_from_days
from wxengine.operators.measures import Measures
from wxengine.operators.mode import rolling_mode, swept_mode
from wxengine.operators.rolling import day_totals, rolling
from wxengine.operators.rolling_length import rolling_length

MEASURES = Measures(averaged=("v",), summed=("v", "w"), maxed=("w",))
SCHEMA = "station_id STRING, station_name STRING, measure_at TIMESTAMP_NTZ, v DOUBLE, w DOUBLE"
UNITS = {HOURLY: "1 hour", DAILY: "1 day", WEEKLY: "7 day", MONTHLY: "1 month"}


def series(seed: int, start: dt.datetime, days: int, per_day: int, step_seconds: int):
    """Irregular readings of a busy, a usual and a sparse station, with NULLs."""
    draw = random.Random(seed)
    rows = []
    for station, share in (("46A", 1.0), ("C0B", 0.3), ("72C", 0.02)):
        slots = days * 86400 // step_seconds
        chosen = draw.sample(range(slots), max(2, min(slots, int(days * per_day * share))))
        for slot in sorted(chosen):
            at = start + dt.timedelta(seconds=slot * step_seconds)
            v = None if draw.random() < 0.2 else round(draw.uniform(-20, 40), 2)
            w = None if station == "72C" else round(draw.uniform(0, 9), 1)
            rows.append((station, f"{station} {slot}", at, v, w))
    return rows


SERIES = {
    "leap year": series(1, dt.datetime(2024, 1, 20), 75, 30, 600),
    "common year": series(2, dt.datetime(2023, 1, 25), 70, 30, 600),
    "year end": series(3, dt.datetime(2023, 12, 20), 50, 40, 1800),
    "dense": series(4, dt.datetime(2024, 2, 28, 12), 3, 1500, 1),
}


def truth(rows, grain, length=None):
    """Exact self-join over ``[t, t + interval]``, keyed by station and time."""
    connection = duckdb.connect()
    connection.execute("CREATE TABLE r (s VARCHAR, n VARCHAR, t TIMESTAMP, v DECIMAL(18,4), w DECIMAL(18,4))")
    connection.executemany("INSERT INTO r VALUES (?, ?, ?, ?, ?)", rows)
    found = connection.execute(
        f"""SELECT a.s, a.t, round(sum(b.v)::DOUBLE / nullif(count(b.v), 0), 6),
                   round(sum(b.v), 2), round(sum(b.w), 2), round(max(b.w), 2)
            FROM r a JOIN r b ON a.s = b.s AND b.t BETWEEN a.t AND a.t + INTERVAL {length or UNITS[grain]}
            GROUP BY a.s, a.t"""
    ).fetchall()
    return {(s, t): values for s, t, *values in found}


def close(got, want):
    if got is None or want is None:
        return got is None and want is None
    return abs(float(got) - float(want)) < 0.005001


def check(found, expected, grain):
    assert len(found) == len(expected)
    names = [f"v_{grain.suffix}_average", f"v_{grain.suffix}_sum", f"w_{grain.suffix}_sum", f"w_{grain.suffix}_max"]
    for row in found:
        want = expected[(row.station_id, row.measure_at)]
        assert all(close(row[n], x) for n, x in zip(names, want)), (row, want)


@pytest.mark.parametrize("name", SERIES)
def test_rolling_equals_self_join(spark, name):
    readings = spark.createDataFrame(SERIES[name], SCHEMA)
    rolled = rolling(readings, GRAINS, MEASURES)
    assert rolled.columns[:5] == readings.columns and len(rolled.columns) == 5 + 4 * 4
    found = rolled.collect()
    for grain in GRAINS:
        check(found, truth(SERIES[name], grain), grain)


@pytest.mark.parametrize("grain", GRAINS, ids=lambda g: g.suffix)
def test_grain_alone_equals_all_grains(spark, grain):
    readings = spark.createDataFrame(SERIES["leap year"], SCHEMA)
    check(rolling(readings, [grain], MEASURES).collect(), truth(SERIES["leap year"], grain), grain)


@pytest.mark.parametrize("grain", GRAINS, ids=lambda g: g.suffix)
@pytest.mark.parametrize("name", SERIES)
def test_anchored_equals_rolling_at_anchors(spark, name, grain):
    readings = spark.createDataFrame(SERIES[name], SCHEMA)
    starts = {
        HOURLY: lambda t: t.replace(minute=0, second=0),
        DAILY: lambda t: t.replace(hour=0, minute=0, second=0),
        WEEKLY: lambda t: t.replace(hour=0, minute=0, second=0) - dt.timedelta(days=t.weekday()),
        MONTHLY: lambda t: t.replace(day=1, hour=0, minute=0, second=0),
    }
    expected = {k: v for k, v in truth(SERIES[name], grain).items() if k[1] == starts[grain](k[1])}
    names = {(s, t): n for s, n, t, _, _ in SERIES[name]}
    found = anchored(readings, grain, MEASURES).collect()
    check(found, expected, grain)
    assert all(r.station_name == names[(r.station_id, r.measure_at)] for r in found)
    if grain != HOURLY:
        check(units_from_days(day_states(readings, MEASURES), grain, MEASURES).collect(), expected, grain)


def test_closed_hour_holds_seven_readings(spark):
    start = dt.datetime(2024, 8, 1, 10)
    rows = [("46A", "n", start + dt.timedelta(minutes=10 * i), 1.0, None) for i in range(8)]
    readings = spark.createDataFrame(rows, SCHEMA)
    first = rolling(readings, [HOURLY], MEASURES).orderBy("measure_at").first()
    assert first.v_hourly_sum == 7.0
    assert (first.w_hourly_sum, first.w_hourly_max) == (None, None)
    assert anchored(readings, HOURLY, MEASURES).orderBy("measure_at").first().v_hourly_sum == 7.0


def test_no_reading_on_the_hour_no_row(spark):
    rows = [("46A", "n", dt.datetime(2024, 8, 1, 10, 10), 1.0, 1.0)]
    assert anchored(spark.createDataFrame(rows, SCHEMA), HOURLY, MEASURES).count() == 0


def test_week_starts_on_monday(spark):
    rows = [
        ("46A", "n", dt.datetime(2024, 8, 4, 23, 50), 5.0, 1.0),
        ("46A", "n", dt.datetime(2024, 8, 5), 1.0, 1.0),
        ("46A", "n", dt.datetime(2024, 8, 12), 2.0, 1.0),
    ]
    found = anchored(spark.createDataFrame(rows, SCHEMA), WEEKLY, MEASURES).orderBy("measure_at").collect()
    assert [(r.measure_at, r.v_weekly_sum) for r in found] == [
        (dt.datetime(2024, 8, 5), 3.0),
        (dt.datetime(2024, 8, 12), 2.0),
    ]


def test_results_do_not_depend_on_the_session_zone(spark):
    readings = spark.createDataFrame(SERIES["year end"], SCHEMA)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = rolling(readings, [DAILY], MEASURES).collect()
        hours = anchored(readings, HOURLY, MEASURES).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    check(found, truth(SERIES["year end"], DAILY), DAILY)
    assert hours == anchored(readings, HOURLY, MEASURES).count()


def test_ties_round_away_from_zero(spark):
    rows = [("46A", "n", dt.datetime(2024, 8, 1), x, None) for x in (1.005,)]
    rows += [("46B", "n", dt.datetime(2024, 8, 1), x, None) for x in (-1.005,)]
    found = rolling(spark.createDataFrame(rows, SCHEMA), [HOURLY], MEASURES).orderBy("station_id").collect()
    assert [r.v_hourly_average for r in found] == [1.01, -1.01]


def test_frame_columns_equal_rolling(spark):
    readings = spark.createDataFrame(SERIES["leap year"], SCHEMA)
    framed = readings.select(
        "station_id",
        "measure_at",
        ahead.averaged_by_datetime("v", "measure_at", "1 day").alias("v_daily_average"),
        ahead.sum_over_datetime("v", "measure_at", "1 day").alias("v_daily_sum"),
        ahead.sum_over_datetime("w", "measure_at", "1 day").alias("w_daily_sum"),
        ahead.find_max_in_interval("w", "measure_at", "1 day").alias("w_daily_max"),
    )
    rolled = rolling(readings, [DAILY], MEASURES).select(*framed.columns)
    assert framed.exceptAll(rolled).count() == 0 and rolled.exceptAll(framed).count() == 0


def test_month_frames_are_refused():
    with pytest.raises(ValueError, match="month"):
        ahead.averaged_by_datetime("v", "measure_at", "1 month")


def test_rolling_mode_crosses_days_and_breaks_ties(spark):
    start = dt.datetime(2024, 8, 1, 23, 30)
    values = [3.0, 1.0, 1.0, 3.0, 2.0, None]
    rows = [("46A", "n", start + dt.timedelta(minutes=10 * i), v, None) for i, v in enumerate(values)]
    found = rolling_mode(spark.createDataFrame(rows, SCHEMA), "v").orderBy("measure_at").collect()
    assert [r.v_mode for r in found] == [1.0, 1.0, 1.0, 2.0, 2.0, None]


def test_rolling_mode_equals_one_frame(spark):
    readings = spark.createDataFrame(SERIES["year end"], SCHEMA)
    for length in ("1 hour", "3 days"):
        split = rolling_mode(readings, "w", length, result="m").select("station_id", "measure_at", "m")
        whole = readings.select(
            "station_id", "measure_at", ahead.find_mode_in_interval("w", "measure_at", length).alias("m")
        )
        assert split.exceptAll(whole).count() == 0 and whole.exceptAll(split).count() == 0


def test_one_station_with_a_third_of_all_rows(spark):
    """The busy station's rows spread over many tasks."""
    readings = spark.createDataFrame(SERIES["leap year"], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rolled = rolling(readings.filter("station_id = '46A'"), [WEEKLY], MEASURES)
        placed = rolled.select(F.spark_partition_id().alias("task"), "v_weekly_sum").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = Counter(row.task for row in placed)
    assert len(sizes) == 8
    assert max(sizes.values()) < 0.4 * sum(sizes.values())


def one_reading(spark, value, at="2024-08-01 10:00:00"):
    rows = spark.createDataFrame([("46", "A", value, value)], "station_id STRING, station_name STRING, v DOUBLE, w DOUBLE")
    return rows.withColumn("measure_at", F.lit(at).cast("timestamp_ntz"))


@pytest.mark.parametrize("grain", GRAINS, ids=lambda g: g.suffix)
def test_a_value_is_rounded_once(spark, grain):
    row = rolling(one_reading(spark, 1.00496), [grain], MEASURES).first()
    names = [f"v_{grain.suffix}_average", f"v_{grain.suffix}_sum", f"w_{grain.suffix}_max"]
    assert [row[n] for n in names] == [1.0, 1.0, 1.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_nan_is_missing_and_overflow_an_error(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = rolling(one_reading(spark, float("nan")), [HOURLY], MEASURES).first()
        assert row["v_hourly_average"] is row["v_hourly_sum"] is row["w_hourly_max"] is None
        with pytest.raises(Exception, match="beyond the exact range"):
            rolling(one_reading(spark, 1e12), [HOURLY], MEASURES).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_reading_without_a_time_counts_once(spark):
    row = rolling(one_reading(spark, 5.0, at=None), GRAINS, MEASURES).first()
    assert {row[f"v_{g.suffix}_sum"] for g in GRAINS} == {5.0}


def mode_truth(rows, length, together=False):
    """Mode by self-join: value of most readings in [t, t + length], the smallest on a tie."""
    connection = duckdb.connect()
    connection.execute("CREATE TABLE r (s VARCHAR, n VARCHAR, t TIMESTAMP, v DOUBLE, w DOUBLE)")
    connection.executemany("INSERT INTO r VALUES (?, ?, ?, ?, ?)", rows)
    same = "true" if together else "a.s = b.s"
    found = connection.execute(
        f"""WITH c AS (SELECT a.s, a.t, b.w, count(b.w) AS n FROM r a JOIN r b
              ON {same} AND b.t BETWEEN a.t AND a.t + INTERVAL {length} GROUP BY ALL)
            SELECT s, t, w FROM c QUALIFY row_number() OVER (PARTITION BY s, t ORDER BY n DESC, w NULLS LAST) = 1"""
    ).fetchall()
    return {(s, t): w for s, t, w in found}


def modes(frame):
    rows = frame.collect()
    found = {(r.station_id, r.measure_at): r.m for r in rows}
    assert len(found) == len(rows)
    return found


def coarse(rows, per_station=4000):
    """Few values, so that counts matter and tie."""
    return [(s, n, t, v, None if w is None else w // 1) for s, n, t, v, w in rows[:per_station]]


@pytest.mark.parametrize(
    ("name", "length"),
    [(name, "1 month") for name in SERIES]
    + [("leap year", "1 day"), ("year end", "1 week"), ("common year", "3 months"), ("dense", "100 minutes")],
)
def test_swept_mode_equals_self_join(spark, name, length):
    rows = coarse(SERIES[name])
    readings = spark.createDataFrame(rows, SCHEMA)
    sql = length if length != "1 week" else "7 days"
    assert modes(swept_mode(readings, "w", length, result="m")) == mode_truth(rows, sql)


@pytest.mark.parametrize("length", ["1 hour", "1 month"])
def test_mode_across_all_stations_equals_self_join(spark, length):
    rows = coarse(SERIES["leap year"], 1500) + coarse(SERIES["leap year"][-300:])
    found = swept_mode(spark.createDataFrame(rows, SCHEMA), "w", length, station=None, result="m")
    assert modes(found) == mode_truth(rows, length, together=True)


def test_swept_mode_of_edge_cases(spark):
    t = dt.datetime(2024, 1, 31, 10)
    rows = [
        (None, "x", t, float("nan"), 1.00496), (None, "x", t + dt.timedelta(days=29), 1.0, 1.00496),
        ("a", "x", None, 1.0, 7.126), ("a", "x", t, 1.0, None), ("b", "x", t, 1.0, -0.0), ("b", "x", t.replace(hour=11), 1.0, 0.0),
        ("b", "x", t.replace(hour=12), 1.0, -1.0),
    ]
    found = modes(swept_mode(spark.createDataFrame(rows, SCHEMA), "w", "1 month", result="m"))
    assert found == {
        (None, t): 1.0, (None, t + dt.timedelta(days=29)): 1.0, ("a", None): 7.13, ("a", t): None,
        ("b", t): 0.0, ("b", t.replace(hour=11)): -1.0, ("b", t.replace(hour=12)): -1.0,
    }
    assert swept_mode(spark.createDataFrame([], SCHEMA), "w", "1 month").collect() == []


def test_macros_round_once(spark):
    rows = [("a", "x", dt.datetime(2024, 1, 1, 0, i), v, v) for i, v in enumerate([1.00496, 1.00496, 1.0049996])]
    found = spark.createDataFrame(rows, SCHEMA).select(
        ahead.find_mode_in_interval("v", "measure_at", "1 hour").alias("mode"),
        ahead.find_max_in_interval("v", "measure_at", "1 hour").alias("max"),
    )
    assert {tuple(r) for r in found.collect()} == {(1.0, 1.0)}


@pytest.mark.parametrize(
    ("name", "length"),
    [(name, "3 months") for name in SERIES]
    + [("leap year", "90 minutes"), ("common year", "36 hours"), ("year end", "10 days"), ("dense", "7 seconds")],
)
def test_rolling_over_any_length_equals_self_join(spark, name, length):
    rows = SERIES[name]
    found = rolling_length(spark.createDataFrame(rows, SCHEMA), length, "long", MEASURES).collect()
    assert len(found) == len(rows)
    expected = truth(rows, None, length)
    for r in found:
        average, sum_v, sum_w, max_w = expected[r.station_id, r.measure_at]
        assert (r.v_long_sum, r.w_long_sum, r.w_long_max) == tuple(
            None if x is None else float(x) for x in (sum_v, sum_w, max_w)
        )
        assert r.v_long_average == (None if average is None else pytest.approx(average, abs=0.005001))


def test_length_of_a_window(spark):
    for text in ("1 fortnight", "0 days", "-1 hour"):
        with pytest.raises(ValueError, match="not a length"):
            rolling_length(spark.createDataFrame([], SCHEMA), text, "x", MEASURES)
    assert rolling_length(spark.createDataFrame([], SCHEMA), "90 minutes", "x", MEASURES).count() == 0
    rows = [("a", "x", None, 1.0, 2.0), ("a", "x", dt.datetime(2024, 1, 1), 3.0, 4.0), (None, "x", dt.datetime(2024, 1, 1), 5.0, 6.0)]
    found = rolling_length(spark.createDataFrame(rows, SCHEMA), "90 minutes", "x", MEASURES).collect()
    assert sorted((r.v, r.v_x_sum, r.w_x_max) for r in found) == [(1.0, 1.0, 2.0), (3.0, 3.0, 4.0), (5.0, 5.0, 6.0)]


def test_rolling_from_stored_days_needs_only_edge_dates(spark):
    """Windows that start on one date, from the readings of where they start and end."""
    rows = SERIES["common year"]
    readings = spark.createDataFrame(rows, SCHEMA)
    days, start = day_totals(readings, MEASURES), dt.date(2023, 1, 31)
    edges = [dt.date(2023, 1, 31), dt.date(2023, 2, 1), dt.date(2023, 2, 7), dt.date(2023, 2, 28)]
    of = F.col("measure_at").cast("date")
    some = rolling(readings.filter(of.isin(edges)), GRAINS, MEASURES, days=days).filter(of == start)
    whole = rolling(readings, GRAINS, MEASURES).filter(of == start)
    assert some.count() > 20
    assert some.exceptAll(whole).count() == 0 and whole.exceptAll(some).count() == 0
