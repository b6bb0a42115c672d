"""Properties that physical plans must keep at any scale."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wxengine.catalog.queries import QUERIES
from wxengine.sources.tables import (
    append_after,
    high_water_mark,
    read_dates,
    read_table,
    write_table,
)

SF_DIR = "/root/testdata/sf0.001"
# Queries that return a stored result have run their plan already.
STORED = {"incremental_append", "late_data_drop", "full_refresh"}
LAZY = sorted(
    n for n in QUERIES if not n.startswith(("stream_", "job_", "artifact_append")) and n not in STORED
)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    limit = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", "2000000")
    yield {name: plan(QUERIES[name](spark, SF_DIR)) for name in LAZY}
    spark.conf.set("spark.sql.maxPlanStringLength", limit)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_single_task_no_python(plans, name):
    text = plans[name]
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python"):
        if name == "closed_windows_only" and operator == "SinglePartition":
            continue  # the one-row maximum
        assert operator not in text


@pytest.mark.parametrize("name", ["dedup_readings", "station_latest", "mode_bucket_global"])
def test_copies_are_dropped_before_the_shuffle(plans, name):
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit .*Partial", plans[name])


@pytest.mark.parametrize("grain", ["hourly", "daily", "weekly", "monthly"])
def test_artifacts_aggregate_before_the_shuffle(plans, grain):
    text = plans[f"agg_{grain}"]
    assert "partial_sum" in text and "HashAggregate" in text and "SortAggregate" not in text
    if grain != "hourly":
        assert "SortAggregate" not in plans[f"agg_{grain}_from_days"]


def test_picking_a_grain_by_suffix_builds_no_other(plans):
    assert "_start_monthly" not in plans["dynamic_select_daily"]


def test_rolling_splits_stations_by_day(plans):
    for exchange in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plans["rolling_all"]):
        assert "_day" in exchange or "measure_at" in exchange or "_of" in exchange


def test_rolling_all_sorts_each_direction_once(plans):
    # Deduplication twice (readings and day states) at two sorts each; two sorts for the
    # blocks; one for the placed starts.
    assert len(re.findall(r"- Sort \[", plans["rolling_all"])) == 2 * 2 + 2 + 1


def test_scans_read_only_needed_columns(plans):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plans["station_fanout"]).group(1)
    assert "c_acctbal" not in schema


@pytest.mark.parametrize("grain", ["hourly", "daily", "weekly", "monthly"])
def test_artifacts_read_and_deduplicate_once(plans, grain):
    text = plans[f"agg_{grain}"]
    assert text.count("Scan parquet") == 1
    # Deduplication, units, and the two rows of a unit.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


def test_the_station_join_reads_each_register_once(plans):
    text = plans["station_fanout"]
    # Both copies of a register are read for the union that the query makes of them.
    assert len(re.findall(r"FileScan parquet \[c_", text)) == 2
    assert len(re.findall(r"FileScan parquet \[s_", text)) == 2
    assert len(re.findall(r"FileScan parquet \[o_", text)) == 1
    assert len(re.findall("SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", text)) == 2


def test_appends_read_only_the_dates_they_need(spark, tmp_path):
    rows = spark.sql(
        "SELECT 'a' AS station_id, 1D AS v, TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(id) AS measure_at FROM range(40)"
    )
    path = str(tmp_path / "t")
    write_table(rows, path, "overwrite")
    assert high_water_mark(spark, path) == dt.datetime(2024, 2, 9)
    text = plan(read_dates(spark, path, dt.date(2024, 2, 8)))
    assert re.search(r"PartitionFilters: \[[^\]]*measure_date[^\]]* >= 2024-02-08", text)
    before = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    new = rows.select("station_id", "v", (F.col("measure_at") + F.expr("INTERVAL '39 12' DAY TO HOUR")).alias("measure_at"))
    last = dt.date(2024, 2, 9)
    append_after(new, path, last, last, F.col("measure_at") <= dt.datetime(2024, 2, 9))
    after = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    old = [f for f in before if "2024-02-09" not in str(f)]
    assert len(old) == 39 and all(before[f] == after[f] for f in old)
    assert read_table(spark, path).count() == 80
