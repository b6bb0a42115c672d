"""What runs leave on the disks of their executors, and what they shuffle."""

import datetime as dt
import re
import time
from pathlib import Path

import payloads
import pytest
from pyspark.sql import functions as F
from test_rolling import MEASURES, SCHEMA, check, series, truth

from wxengine.catalog import inputs
from wxengine.functions.calendar import MONTHLY, WEEKLY
from wxengine.operators.rolling import rolling
from wxengine.plans import jobs, staging
from wxengine.session import DROP_SHUFFLES, dropped_shuffles
from wxengine.sources.landing import MEASUREMENTS, read_landing
from wxengine.sources.tables import read_table


def shuffles(spark) -> set[int]:
    """Numbers of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = files.mkString(" ")
    return {int(n) for n in re.findall(r"/shuffle_(\d+)_\d+_\d+\.data", names)}


def left_after(spark, before: set[int]) -> set[int]:
    """Shuffles that came since; files go in the background, so some seconds are allowed."""
    until = time.time() + 20
    while (left := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def land(layout, day, steps):
    for step in steps:
        moment = dt.datetime(2024, 7, day) + dt.timedelta(minutes=10 * step)
        items = [payloads.station(s, moment.isoformat() + "+08:00") for s in ("466920", "C0A520")]
        arrival = moment.strftime("%Y-%m-%d_%H_%M")
        payloads.land(Path(layout.landed(MEASUREMENTS)), arrival, payloads.measurements(*items))


def test_runs_and_repairs_leave_no_shuffle_files(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))
    setting = spark.conf.get(DROP_SHUFFLES, None)
    before = shuffles(spark)
    for day, steps in ((1, range(8)), (31, range(8)), (30, range(2))):
        land(layout, day, steps)
        jobs.run_ingest(spark, layout, (MEASUREMENTS,))
        jobs.run_measurements(spark, layout)
    assert left_after(spark, before) == set()
    jobs.repair(spark, layout)
    jobs.run_measurements(spark, layout, full_refresh=True)
    assert left_after(spark, before) == set()
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    assert read_table(spark, layout.rolling).count() == 18 * 2


def test_the_setting_comes_back(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    with pytest.raises(KeyError), dropped_shuffles(spark, spark.newSession()):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise KeyError
    assert spark.conf.get(DROP_SHUFFLES, None) == before


def exchanges(frame) -> list[tuple[str, str]]:
    """Columns and arguments of the shuffles of a plan."""
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = frame._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) Exchange\nInput[^:]*: (\[.*\])\nArguments: (.*)\n", text)


def test_readings_and_days_are_shuffled_as_they_are(spark):
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        found = exchanges(rolling(spark.createDataFrame([], SCHEMA), [WEEKLY, MONTHLY], MEASURES))
    finally:
        spark.conf.unset("spark.sql.maxToStringFields")
    assert len(found) == 4
    # Readings go without their states, and days without the places that they count in.
    (readings,) = [columns for columns, by in found if "measure_at" in columns and "_rest_day" not in columns]
    assert "sum_v" not in readings
    (days,) = [columns for columns, by in found if by.startswith("hashpartitioning(_of_chunk")]
    assert "_day" not in days and "weekly_" not in days


@pytest.mark.parametrize("grain", [WEEKLY, MONTHLY], ids=lambda g: g.suffix)
def test_rolling_before_1970(spark, grain):
    """Days are numbered from 1970 on, below zero before."""
    rows = series(5, dt.datetime(1969, 11, 20), 75, 10, 600)
    found = rolling(spark.createDataFrame(rows, SCHEMA), [grain], MEASURES).collect()
    check(found, truth(rows, grain), grain)


def test_days_count_once_where_many_are_missing(spark):
    """Chunks of days without readings lie between; a week and a month reach into the next."""
    days = ("1899-12-31", "2023-11-30", "2023-12-06", "2023-12-31", "2024-01-01", "2024-02-29", "2031-05-05")
    rows = [("46A", day, dt.datetime.fromisoformat(day), 1.0, 2.0) for day in days]
    rows.append((None, "nowhere", dt.datetime(2024, 2, 29), 1.0, 2.0))
    found = rolling(spark.createDataFrame(rows, SCHEMA), [WEEKLY, MONTHLY], MEASURES)
    of = {r.station_name: (r.v_weekly_sum, r.v_monthly_sum) for r in found.collect()}
    ones = {day: (1.0, 1.0) for day in (*days, "nowhere")}
    assert of == ones | {"2023-11-30": (2.0, 2.0), "2023-12-06": (1.0, 3.0), "2023-12-31": (2.0, 2.0)}


def test_landed_steps_are_compressed_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "RESPONSES_PER_FILE", 2)
    rows = spark.range(400).selectExpr(
        "id AS event_id",
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS ts",
        "id % 3 * 32 AS user_id",
        "'view' AS event_type",
        "id + 0.5D AS value",
        "'{\"k\": 3}' AS props",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = shuffles(spark)
    arrivals = inputs.stored_arrivals(spark, str(tmp_path))
    folder = f"{tmp_path}/landed"
    for step in range(inputs.STEPS):
        inputs.land_step(spark, arrivals, step, folder)
    assert left_after(spark, before) == set()
    files = [f for f in Path(folder).rglob("part-*") if not f.name.endswith(".crc")]
    assert files and all(f.name.endswith(".gz") for f in files)
    landed = read_landing(spark, folder)
    assert landed.groupBy("landed_file").count().agg(F.max("count")).first()[0] <= 2
    parsed = staging.parsed_measurements(landed).select("station_id", "measure_at", "air_temperature")
    want = arrivals.select(*parsed.columns)
    assert parsed.exceptAll(want).count() == 0 and want.exceptAll(parsed).count() == 0
    assert want.count() > 400
