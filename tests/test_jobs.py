"""Runs over a warehouse folder: ingest, incremental runs, late data, full refresh."""

import datetime as dt
from pathlib import Path

import payloads
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wxengine.functions.calendar import DAILY, GRAINS, HOURLY
from wxengine.operators.measures import Measures
from wxengine.operators.select_suffix import publish
from wxengine.plans import jobs
from wxengine.plans.measurements import closed_windows, update_rolling
from wxengine.operators.rolling import rolling
from wxengine.sources.landing import (
    MEASUREMENTS,
    RAIN_STATIONS,
    WEATHER_STATIONS,
    archive_path,
    compact_archive,
    compacted_path,
    read_archive,
    read_landing,
)
from wxengine.session import shared_dir
from wxengine.sources.files import subfolders
from wxengine.sources.marks import Mark, last_mark, log_of, write_mark
from wxengine.sources.tables import high_water_mark, read_table

START = dt.datetime(2024, 7, 31, 22)
MEASURES = Measures(averaged=("air_temperature",), summed=("precipitation",), maxed=("wind_speed",))
READINGS = "station_id STRING, measure_at TIMESTAMP_NTZ, air_temperature DOUBLE, precipitation DOUBLE, wind_speed DOUBLE"


def at(step):
    return START + dt.timedelta(minutes=10 * step)


def land_readings(layout, steps, temperature="20.0"):
    for step in steps:
        arrival = (at(step) + dt.timedelta(minutes=3)).strftime("%Y-%m-%d_%H_%M")
        moment = at(step).isoformat() + "+08:00"
        items = [payloads.station(s, moment, temperature=temperature) for s in ("466920", "C0A520")]
        payloads.land(Path(layout.landed(MEASUREMENTS)), arrival, payloads.measurements(*items))


@pytest.fixture
def layout(tmp_path):
    return jobs.Layout(str(tmp_path / "landing"), str(tmp_path / "warehouse"))


def hours(spark, layout):
    rows = read_table(spark, layout.artifact("hourly")).filter("station_id = '466920'")
    return {r.measure_at: r for r in rows.collect()}


def test_incremental_runs_late_data_and_refresh(spark, layout):
    only = (MEASUREMENTS,)
    land_readings(layout, [s for s in range(16) if s != 7])
    jobs.run_ingest(spark, layout, only)
    jobs.run_measurements(spark, layout)
    rolled = read_table(spark, layout.rolling)
    assert len(rolled.columns) == 16 + 52
    assert rolled.count() == 15 * 2
    first = hours(spark, layout)
    assert sorted(first) == [at(0), at(6), at(12)]
    assert first[at(12)].precipitation_sum == 2.0  # four readings of an hour still open
    assert first[at(6)].precipitation_sum == 3.0  # reading 7 is missing

    land_readings(layout, [7, 16, 17, 18])
    jobs.run_ingest(spark, layout, only)
    jobs.run_measurements(spark, layout)
    second = hours(spark, layout)
    assert sorted(second) == [at(0), at(6), at(12), at(18)]
    assert second[at(12)].precipitation_sum == 2.0  # frozen as it was stored
    assert second[at(6)].precipitation_sum == 3.0  # the late reading stays out
    assert read_table(spark, layout.rolling).count() == 18 * 2

    jobs.run_measurements(spark, layout)  # nothing new
    assert read_table(spark, layout.rolling).count() == 18 * 2

    jobs.run_measurements(spark, layout, full_refresh=True)
    third = hours(spark, layout)
    assert third[at(12)].precipitation_sum == 3.5
    assert third[at(6)].precipitation_sum == 3.5
    assert read_table(spark, layout.rolling).count() == 19 * 2

    names = [
        "station_id", "station_name", "station_type", "measure_at",
        "air_temperature", "air_pressure", "relative_humidity", "wind_speed", "precipitation",
        "precipitation_sum", "sunshine_duration",
        "air_temperaturemax", "air_pressuremax", "relative_humiditymax", "wind_speedmax",
        "peak_gust_speedmax", "precipitationmax",
    ]
    assert read_table(spark, layout.artifact("hourly")).columns == names
    assert read_table(spark, layout.artifact("monthly")).columns == names


def test_everything_from_landed_files(spark, layout):
    land_readings(layout, range(13))
    rain = payloads.rain_register(payloads.rain_station("C0A520"))
    weather = payloads.weather_register(
        payloads.weather_station("466920"), payloads.weather_station("C1X", "已撤銷")
    )
    payloads.land(Path(layout.landed(RAIN_STATIONS)), "2024-08-01_12_01", rain)
    payloads.land(Path(layout.landed(WEATHER_STATIONS)), "2024-08-01_12_01", weather)
    jobs.full_refresh(spark, layout)

    existing = layout.artifact("existing_stations")
    assert [r.station_id for r in spark.read.parquet(existing).collect()] == ["466920"]
    assert spark.read.parquet(layout.artifact("revoked_stations")).count() == 1
    assert spark.read.parquet(layout.stations).count() == 3
    # Midnight lies inside the series, and so does the first of the month.
    for name in ("daily", "monthly"):
        assert read_table(spark, layout.artifact(name)).count() == 2
    assert read_table(spark, layout.artifact("weekly")) is None

    jobs.run_stations(spark, layout, append_lists=True)
    assert spark.read.parquet(existing).count() == 2


def frame(spark, steps, station="466920"):
    return spark.createDataFrame([(station, at(s), 1.0, 1.0, 1.0) for s in steps], READINGS)


def test_empty_target_takes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    update_rolling(spark, frame(spark, [0]).limit(0), target, [HOURLY], MEASURES)
    update_rolling(spark, frame(spark, [0, 1]), target, [HOURLY], MEASURES)
    assert read_table(spark, target) is None
    update_rolling(spark, frame(spark, [0, 1]), target, [HOURLY], MEASURES, full_refresh=True)
    assert read_table(spark, target).count() == 2


def test_high_water_mark_is_over_all_stations(spark, tmp_path):
    target = str(tmp_path / "t")
    update_rolling(spark, frame(spark, [5]), target, [HOURLY], MEASURES)
    both = frame(spark, [5, 6]).unionAll(frame(spark, [4, 7], "C0A520"))
    update_rolling(spark, both, target, [HOURLY], MEASURES)
    found = {(r.station_id, r.measure_at) for r in read_table(spark, target).collect()}
    assert found == {("466920", at(5)), ("466920", at(6)), ("C0A520", at(7))}


def test_a_run_computes_its_readings_once(spark, tmp_path):
    seen, target = spark.sparkContext.accumulator(0), str(tmp_path / "t")

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for until in (10, 20):
        readings = frame(spark, range(until)).coalesce(1).mapInArrow(counted, READINGS)
        update_rolling(spark, readings, target, GRAINS, MEASURES)
    assert seen.value == 10 + 20
    assert read_table(spark, target).count() == 20


def test_only_closed_runs_end_like_one_run(spark, tmp_path):
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    update_rolling(spark, frame(spark, range(40)), once, [HOURLY], MEASURES, only_closed=True)
    for until in (11, 25, 40):
        update_rolling(
            spark, frame(spark, range(until)), twice, [HOURLY], MEASURES, only_closed=True
        )
    a, b = read_table(spark, once), read_table(spark, twice)
    assert a.count() == 34  # the last hour is still open
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_closed_windows(spark):
    readings = frame(spark, range(150))
    closed = closed_windows(rolling(readings, [DAILY], MEASURES), readings, DAILY)
    assert sorted(r.measure_at for r in closed.collect()) == [at(s) for s in range(6)]


def test_suffixes_in_any_case(spark):
    columns = "1 AS station_id, 1 AS station_name, 1 AS station_type, 1 AS measure_at"
    rows = spark.sql(
        f"SELECT {columns}, 1 AS PRECIPITATION_HOURLY_SUM, 2 AS SUNSHINE_DURATION_10MIN_HOURLY_SUM,"
        " 3 AS PRECIPITATION_HOURLY_AVERAGE, 4 AS PRECIPITATION_HOURLY_MAX, 5 AS X_DAILY_MAX"
    )
    assert publish(rows, HOURLY).columns[4:] == [
        "precipitation_sum",
        "sunshine_duration",
        "precipitation",
        "precipitationmax",
    ]


def test_shared_folder_is_the_one_the_cluster_names():
    class Session:
        def __init__(self, **conf):
            self.conf = self
            self.get = lambda key, default=None: conf.get(key.replace(".", "_"), default)

    named = shared_dir(Session(spark_checkpoint_dir="s3a://bucket/shared/"), "x")
    assert named.startswith("s3a://bucket/shared/wxengine/x-")
    local = Session(spark_master="local[2]")
    assert shared_dir(local, "x") != shared_dir(local, "x")
    for cluster in (Session(), Session(spark_master="spark://host:7077"), Session(spark_master="yarn")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(cluster, "x")


def test_a_reading_timed_after_its_arrival_is_not_lost(spark, layout):
    def land(arrival, moment):
        item = payloads.station("466920", moment, temperature="20.0")
        payloads.land(Path(layout.landed(MEASUREMENTS)), arrival, payloads.measurements(item))

    land("2024-06-01_00_03", "2024-06-01T00:00:00")
    land("2024-07-08_00_03", "2024-07-08T00:00:00")
    land("2024-08-01_00_03", "2024-08-10T00:00:00")
    jobs.run_ingest(spark, layout)  # the registers have not landed yet
    jobs.run_measurements(spark, layout, only_closed=True)
    land("2024-10-01_00_03", "2024-10-01T00:00:00")
    jobs.run_ingest(spark, layout)
    jobs.run_measurements(spark, layout, only_closed=True)
    found = sorted(r.measure_at for r in read_table(spark, layout.rolling).collect())
    jobs.run_measurements(spark, layout, full_refresh=True, only_closed=True)
    assert found == sorted(r.measure_at for r in read_table(spark, layout.rolling).collect())
    assert dt.datetime(2024, 8, 10) in found


def frozen(frame):
    """The rows as they are now."""
    return frame.sparkSession.createDataFrame(frame.collect(), frame.schema)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def stamps(folder):
    """Names and times of a table's files by partition."""
    return {
        d.name: sorted((f.name, f.stat().st_mtime_ns) for f in d.glob("*.parquet"))
        for d in Path(folder).glob("measure_date=*")
    }


MOMENTS = [  # days after the start and stations of readings, by run; windows reach over months
    [(d, s) for d in range(0, 40) for s in ("466920", "C0A520")],
    [(d, s) for d in range(40, 75) for s in ("466920", "C0A520")] + [(3, "72X"), (38, "466921")],
    [(d, s) for d in range(75, 80) for s in ("466920", "C0A520")] + [(39, "466921"), (3, "466920")],
]


def land_days(layout, moments, run):
    items = [
        payloads.station(s, (dt.datetime(2023, 12, 31, 6) + dt.timedelta(days=d)).isoformat(), temperature=str(10 + d % 9))
        for d, s in moments
    ]
    payloads.land(Path(layout.landed(MEASUREMENTS)), f"2024-05-0{run + 1}_00_03", payloads.measurements(*items))


@pytest.mark.parametrize("only_closed", [False, True])
def test_a_repair_ends_like_a_full_refresh(spark, layout, only_closed):
    for run, moments in enumerate(MOMENTS):
        land_days(layout, moments, run)
        jobs.run_ingest(spark, layout, (MEASUREMENTS,))
        jobs.run_measurements(spark, layout, only_closed=only_closed)
    before = stamps(layout.rolling)
    assert read_table(spark, layout.readings).count() == 160
    jobs.repair(spark, layout, only_closed)
    after = stamps(layout.rolling)
    tables = [layout.readings, layout.rolling, *(layout.artifact(g.suffix) for g in jobs.GRAINS)]
    repaired = {t: frozen(read_table(spark, t)) for t in tables if subfolders(spark, t)}
    jobs.run_measurements(spark, layout, full_refresh=True, only_closed=only_closed)
    for table, rows in repaired.items():
        assert same(read_table(spark, table), rows), table
    assert repaired[layout.readings].count() == 163
    # Late on days 3, 38 and 39, in windows from a month before; open windows begin later.
    untouched = [n for n in before if "measure_date=2024-01-04" <= n <= "measure_date=2024-01-06"]
    assert len(untouched) == 3 and all(before[n] == after[n] for n in untouched)
    jobs.repair(spark, layout, only_closed)  # nothing to do
    assert same(read_table(spark, layout.rolling), repaired[layout.rolling])


def test_a_run_that_is_repeated_changes_nothing(spark, layout):
    for run, moments in enumerate(MOMENTS):
        land_days(layout, moments, run)
        jobs.run_ingest(spark, layout, (MEASUREMENTS,))
        before = last_mark(spark, log_of(layout.readings))
        jobs.run_measurements(spark, layout)
        first = frozen(read_table(spark, layout.rolling))
        archive = spark.read.parquet(f"{layout.archive}/feed={MEASUREMENTS}")
        own = archive.filter(f"ingest_date = date'2024-05-0{run + 1}'")
        number = 0 if before is None else before.number + 1
        assert last_mark(spark, log_of(layout.readings)).number == number
        jobs.apply_responses(spark, layout, own, number)
        assert same(first, read_table(spark, layout.rolling))


def test_no_run_reads_a_response_twice(spark, layout, monkeypatch):
    read = []
    apply = jobs.apply_responses

    def counted(spark, layout, responses, number, only_closed=False):
        read.extend(r.landed_file for r in responses.select("landed_file").collect())
        apply(spark, layout, responses, number, only_closed)

    monkeypatch.setattr(jobs, "apply_responses", counted)
    for run, moments in enumerate(MOMENTS):
        land_days(layout, moments[:6], run)
        jobs.run_ingest(spark, layout, (MEASUREMENTS,))
        jobs.run_measurements(spark, layout)
        jobs.run_measurements(spark, layout)
    assert len(read) == len(set(read)) == 3


def test_a_failed_append_leaves_no_mark(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    update_rolling(spark, frame(spark, range(10)), target, [HOURLY], MEASURES)
    good = frozen(read_table(spark, target))

    def fails(*args, **kwargs):
        raise OSError("the run ends here")

    # The rows are written, the mark is not: the next run writes them anew.
    with monkeypatch.context() as patch:
        patch.setattr("wxengine.plans.measurements.write_mark", fails)
        with pytest.raises(OSError, match="ends here"):
            update_rolling(spark, frame(spark, range(400)), target, [HOURLY], MEASURES)
    assert high_water_mark(spark, target) == at(399)
    assert last_mark(spark, log_of(target)).at == at(9)
    update_rolling(spark, frame(spark, range(20)), target, [HOURLY], MEASURES)
    found = read_table(spark, target)
    assert found.count() == 20 and good.exceptAll(found).count() == 0


def test_the_log_of_runs(spark, tmp_path):
    log = log_of(str(tmp_path / "t"))
    assert last_mark(spark, log) is None
    for number in range(20):
        write_mark(spark, log, Mark(number, at(number) if number % 2 else None))
    assert last_mark(spark, log) == Mark(19, at(19))
    assert last_mark(spark, log, before=19) == Mark(18, None)
    assert len(subfolders(spark, log)) == 16
    write_mark(spark, log, Mark(19, at(50)))
    assert last_mark(spark, log).at == at(50)
    # An entry that was not written to its end does not count.
    (Path(f"{log}/run=19") / "_SUCCESS").unlink()
    assert last_mark(spark, log) == Mark(18, None)


def test_geography_is_taken_apart_once(spark, layout, monkeypatch):
    counted = []
    for day in (1, 2):
        items = [payloads.station(s, f"2024-05-0{day}T00:00:00", coordinates=(("f", str(day), "2"),)) for s in ("a", "b")]
        payloads.land(Path(layout.landed(MEASUREMENTS)), f"2024-05-0{day}_00_03", payloads.measurements(*items, items[0]))
        jobs.run_ingest(spark, layout)
        jobs.run_geography(spark, layout)
        jobs.run_geography(spark, layout, latest_snapshot=True)
        counted.append(spark.read.parquet(layout.geo).count())
    assert counted == [2, 4]
    jobs.run_geography(spark, layout)
    assert spark.read.parquet(layout.geo).count() == 4
    jobs.run_stations(spark, layout, latest_snapshot=True)
    assert [r.station_latitude_tw97 for r in spark.read.parquet(layout.stations).collect()] == [2.0, 2.0]
    jobs.run_stations(spark, layout)
    assert spark.read.parquet(layout.stations).count() == 4


def _values(responses):
    return sorted(row[0] for row in responses.select(F.to_json("value")).collect())


@pytest.mark.parametrize("compacted", [False, True])
def test_archived_responses_are_stored_whole(spark, layout, compacted):
    """Not as a column per field, from which every reader would put them together again."""
    land_readings(layout, range(3))
    jobs.run_ingest(spark, layout)
    path = archive_path(layout.archive, MEASUREMENTS)
    landed = _values(read_landing(spark, layout.landed(MEASUREMENTS)))
    if compacted:
        compact_archive(spark, layout.archive, MEASUREMENTS)
        path = compacted_path(layout.archive, MEASUREMENTS)
    files = list(Path(path).rglob("*.parquet"))
    columns = {column.path for file in files for column in pq.ParquetFile(file).schema}
    assert columns == {"value.value", "value.metadata", "landed_file", "arrived_at"}
    assert len(landed) == 3 and _values(read_archive(spark, layout.archive, MEASUREMENTS)) == landed
