"""Streams fed file by file: restarts, disorder, repeats and open units."""

import datetime as dt
from pathlib import Path

import payloads
import pytest
from pyspark.sql import functions as F

from wxengine.functions.calendar import (
    DAILY,
    HOURLY,
    MONTHLY,
    WEEKLY,
    instant_to_wall,
    wall_to_instant,
)
from wxengine.operators.anchored import anchored
from wxengine.operators.day_states import units_from_days
from wxengine.operators.measures import Measures
from wxengine.plans import staging
from wxengine.sources.landing import (
    MEASUREMENTS,
    arrived_at,
    compact_archive,
    compact_landing,
    read_archive,
    read_landing,
    stream_landing,
)
from wxengine.sources.files import subfolders
from wxengine.streaming import aggregate, ingest

MEASURES = Measures(averaged=("air_temperature",), summed=("precipitation",), maxed=("air_temperature",))
START = dt.datetime(2024, 7, 30, 21)


def response(steps, station="466920"):
    return payloads.measurements(
        *[
            payloads.station(
                station,
                (START + dt.timedelta(minutes=10 * s)).isoformat() + "+08:00",
                temperature=str(20 + s % 7),
                precipitation=str(s % 5),
            )
            for s in steps
        ]
    )


class Feed:
    """A landing folder with the streams over it."""

    def __init__(self, spark, root: Path):
        self.spark, self.root, self.files = spark, root, 0
        (root / "landing").mkdir()

    def land(self, *responses):
        self.files += 1
        payloads.land(self.root / "landing", f"2024-08-01_10_{self.files:02d}", *responses)

    def readings(self):
        responses = stream_landing(self.spark, str(self.root / "landing"), 1)
        return staging.cleaned(staging.parsed_measurements(responses))

    def batch(self):
        return staging.measurements(read_landing(self.spark, str(self.root / "landing")))

    def path(self, name):
        return str(self.root / name)

    def run(self, write, rows, name):
        write(rows, self.path(name), self.path(name + "-checkpoint")).awaitTermination()


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_each_file_is_archived_once(spark, feed):
    for part in (range(3), range(3, 5)):
        feed.land(response(part))
        ingest.ingest(
            spark, feed.path("landing"), feed.path("archive"), MEASUREMENTS, feed.path("c")
        ).awaitTermination()
    archive = read_archive(spark, feed.path("archive"), MEASUREMENTS)
    assert archive.count() == 2
    assert {str(r.ingest_date) for r in archive.collect()} == {"2024-08-01"}
    assert staging.measurements(archive).count() == 5
    since = dt.date(2024, 8, 2)
    assert read_archive(spark, feed.path("archive"), MEASUREMENTS, since).count() == 0


def test_repeats_within_and_across_batches(spark, feed):
    feed.land(response([0, 1, 1]), response([1, 2]))
    feed.land(response([2, 0, 3]))
    unique = aggregate.dedup_stream(feed.readings(), "1 day").select("station_id", "measure_at")
    feed.run(ingest.append_rows, unique, "unique")
    feed.land(response([3, 4]))
    feed.run(ingest.append_rows, unique, "unique")
    found = spark.read.parquet(feed.path("unique"))
    assert found.count() == found.distinct().count() == 5


@pytest.mark.parametrize("grain", [HOURLY, DAILY, WEEKLY], ids=lambda g: g.suffix)
def test_updates_in_any_order_equal_batch(spark, feed, grain):
    feed.land(response(range(300, 1500)))
    feed.land(response(range(0, 310)), response(range(0, 1200, 3), "C0A520"))
    feed.land(response(range(1490, 1600)))
    units = aggregate.stream_units(feed.readings(), grain, "60 days", MEASURES)
    feed.run(ingest.write_versions, units, "units")
    found = ingest.newest_version(spark, feed.path("units"), ("station_id", "measure_at"))
    assert same(anchored(feed.batch(), grain, MEASURES), found)


def test_only_closed_hours_are_appended(spark, feed):
    hours = aggregate.stream_units(feed.readings(), HOURLY, "1 hour", MEASURES)
    expected = None
    for first in range(0, 60, 20):
        feed.land(response(range(first, first + 20)))
        feed.run(ingest.append_rows, hours, "hours")
        latest = START + dt.timedelta(minutes=10 * (first + 19))
        expected = anchored(feed.batch(), HOURLY, MEASURES).filter(
            f"measure_at + INTERVAL '2' HOUR <= TIMESTAMP_NTZ '{latest}'"
        )
        assert same(expected, spark.read.parquet(feed.path("hours")))
    assert expected.count() > 5


def test_months_from_streamed_days(spark, feed):
    feed.land(response(range(0, 4000, 2)))
    feed.land(response(range(3990, 5200)))
    days = aggregate.stream_day_states(feed.readings(), "90 days", MEASURES)
    feed.run(ingest.write_versions, days, "days")
    stored = ingest.newest_version(spark, feed.path("days"), ("station_id", "measure_date"))
    found = units_from_days(stored, MONTHLY, MEASURES)
    assert same(anchored(feed.batch(), MONTHLY, MEASURES), found) and found.count() == 2


def test_months_have_no_tumbling_window(feed):
    with pytest.raises(ValueError, match="stream_day_states"):
        feed.land(response([0]))
        aggregate.stream_units(feed.readings(), MONTHLY, "1 day", MEASURES)


def test_instants_ignore_daylight_saving(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        walls = spark.sql(
            "SELECT explode(sequence(TIMESTAMP_NTZ '2024-03-09 00:00:00',"
            " TIMESTAMP_NTZ '2024-03-12 00:00:00', INTERVAL '10' MINUTE)) AS wall"
        )
        micro = F.expr("INTERVAL '0.000001' SECOND")
        walls = walls.unionAll(walls.select(F.col("wall") - micro))
        instant = wall_to_instant(F.col("wall"))
        back = walls.select("wall", instant.alias("i"), instant_to_wall(instant).alias("back"))
        steps = back.agg(F.max(F.unix_micros("i")) - F.min(F.unix_micros("i"))).first()[0]
        assert back.filter("wall <> back").count() == 0
        assert steps == 3 * 86400 * 10**6 + 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_reading_just_before_a_boundary_is_kept(spark, feed):
    moments = ["2024-07-31T09:00:00", "2024-07-31T09:59:59.999999", "2024-07-31T10:00:00"]
    feed.land(payloads.measurements(*[payloads.station("466920", m, precipitation=str(k + 1)) for k, m in enumerate(moments)]))
    units = aggregate.stream_units(feed.readings(), HOURLY, "1 day", MEASURES)
    feed.run(ingest.write_versions, units, "units")
    found = ingest.newest_version(spark, feed.path("units"), ("station_id", "measure_at"))
    assert same(anchored(feed.batch(), HOURLY, MEASURES), found)
    assert {r.precipitation_hourly_sum for r in found.collect()} == {6.0, 3.0}


def test_stream_and_compaction_share_an_archive(spark, feed):
    archive, checkpoint = feed.path("archive"), feed.path("archive-checkpoint")
    landing = str(feed.root / "landing")

    def archived():
        return read_archive(spark, archive, MEASUREMENTS).select("landed_file").count()

    assert archived() == 0
    for round_ in range(1, 3):
        feed.land(response([round_]))
        ingest.ingest(spark, landing, archive, MEASUREMENTS, checkpoint).awaitTermination()
        compact_archive(spark, archive, MEASUREMENTS)
        assert archived() == round_
        compact_archive(spark, archive, MEASUREMENTS)
        assert archived() == round_
    feed.land(response([9]))
    compact_landing(read_landing(spark, landing), archive, MEASUREMENTS)
    ingest.ingest(spark, landing, archive, MEASUREMENTS, checkpoint).awaitTermination()
    assert archived() == 3


def test_arrival_comes_from_the_end_of_the_path(spark):
    paths = ["x/backup-2023-01-01_00_00/weather-2024-08-01_10_03.json", "x/2024-13-45_99_99.json", "x/none.json"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(arrived_at("p").alias("a")).collect()
    assert [r.a for r in got] == [dt.datetime(2024, 8, 1, 10, 3), None, None]


def test_versions_are_folded(spark, tmp_path):
    """Many batches leave a bounded number of folders, and the newest version of each row."""
    target, keys = str(tmp_path / "versions"), ("k",)
    want = {}
    for number in range(100):
        rows = [(k, number) for k in {number % 7, number // 10}]
        want |= dict(rows)
        batch = spark.createDataFrame(rows, "k int, v int").coalesce(1)
        for _ in range(2 if number % 9 == 0 else 1):  # repeated now and then
            ingest.store_version(spark, batch, number, target, keys, fold_after=8)
        assert len(subfolders(spark, target)) <= 10
    found = {r.k: r.v for r in ingest.newest_version(spark, target, keys).collect()}
    assert found == want


def test_a_fold_that_was_interrupted_does_no_harm(spark, tmp_path, monkeypatch):
    target, keys = str(tmp_path / "versions"), ("k",)
    for number in range(5):
        batch = spark.createDataFrame([(1, number), (number + 2, number)], "k int, v int").coalesce(1)
        ingest.store_version(spark, batch, number, target)
    want = sorted(map(tuple, ingest.newest_version(spark, target, keys).collect()))

    def fails(*args):
        raise OSError("ends here")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "delete", fails)
        with pytest.raises(OSError, match="ends here"):
            ingest.fold_versions(spark, target, keys, before=4)
    assert sorted(map(tuple, ingest.newest_version(spark, target, keys).collect())) == want
    ingest.fold_versions(spark, target, keys)
    assert subfolders(spark, target) == ["through=4"]
    assert sorted(map(tuple, ingest.newest_version(spark, target, keys).collect())) == want
