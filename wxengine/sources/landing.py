"""Landed JSON responses: one response per line, schema applied on read."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader

# Folders of the feeds in the landing area, and the name of a landed file,
# which ends in the wall-clock minute of its arrival (for example
# weather_report_10min-2024-08-01_10_03.json).
MEASUREMENTS = "weather_record"
WEATHER_STATIONS = "weather_station_info"
RAIN_STATIONS = "rain_fall_station"
ARCHIVED = ("value", "landed_file", "arrived_at")
# Responses are read whole. Spark's default takes each apart into a column per field of its
# arrays' elements, from which every reader would have to put it together again.
WHOLE_VARIANTS = {"spark.sql.variant.inferShreddingSchema": "false"}
_ARCHIVE_SCHEMA = "value variant, landed_file string, arrived_at timestamp_ntz"
ARRIVAL_IN_NAME = r"(\d{4}-\d{2}-\d{2})_(\d{2})_(\d{2})"


def _with_file(raw: DataFrame) -> DataFrame:
    return raw.select("value", F.col("_metadata.file_path").alias("landed_file"))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Responses as one VARIANT column ``value`` with the file each came from."""
    reader = spark.read.option("singleVariantColumn", "value")
    return _with_file(reader.option("recursiveFileLookup", "true").json(path))


def stream_landing(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same as a stream of newly arriving files."""
    reader: DataStreamReader = (
        spark.readStream.format("json")
        .option("singleVariantColumn", "value")
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_file(reader.load(path))


def arrived_at(landed_file: Column | str) -> Column:
    """Arrival minute: the last one in a landed file's path; NULL where there is none.

    That is the file's name, or, where the name holds no time, the nearest folder's.
    """
    landed_file = F.col(landed_file) if isinstance(landed_file, str) else landed_file
    date, hour, minute = (F.regexp_extract(landed_file, f".*{ARRIVAL_IN_NAME}", i) for i in (1, 2, 3))
    return F.when(
        date != "", F.concat(date, F.lit(" "), hour, F.lit(":"), minute).try_cast("timestamp_ntz")
    )


def stream_archive(
    spark: SparkSession, archive: str, feed: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Responses of a feed as a stream of what ``streaming.ingest`` newly archives."""
    schema = f"{_ARCHIVE_SCHEMA}, ingest_date date"
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(archive_path(archive, feed))


def with_arrival(responses: DataFrame) -> DataFrame:
    """Add arrival minute and arrival date, the partition of the archive."""
    arrived = responses.withColumn("arrived_at", arrived_at("landed_file"))
    return arrived.withColumn("ingest_date", F.col("arrived_at").cast("date"))


def archive_path(archive: str, feed: str) -> str:
    return f"{archive}/feed={feed}"


def compacted_path(archive: str, feed: str) -> str:
    return f"{archive}/compacted/feed={feed}"


def compact_landing(responses: DataFrame, archive: str, feed: str) -> None:
    """Archive landed responses of a feed as Parquet by arrival date.

    Many small files become few large ones: the rebalance gathers the rows of a date and
    splits a date that is too big for one task. Files that are compacted already are left
    out. The stream's part of the archive is a folder of its own, whose log of files this
    does not touch; ``read_archive`` reads both, each landed file from one of them.
    """
    arrived = responses if "ingest_date" in responses.columns else with_arrival(responses)
    done = _stored(responses.sparkSession, compacted_path(archive, feed))
    if done is not None:
        files = done.select("landed_file").distinct()
        arrived = arrived.join(files, "landed_file", "left_anti")
    (
        arrived.select(*ARCHIVED, "ingest_date")
        .hint("rebalance", "ingest_date")
        .write.mode("append")
        .options(**WHOLE_VARIANTS)
        .partitionBy("ingest_date")
        .parquet(compacted_path(archive, feed))
    )


def compact_archive(spark: SparkSession, archive: str, feed: str) -> None:
    """Compact what the stream has archived and is not compacted yet."""
    streamed = _stored(spark, archive_path(archive, feed))
    if streamed is not None:
        compact_landing(streamed, archive, feed)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path; None where nothing was ever written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_archive(
    spark: SparkSession, archive: str, feed: str, since: dt.date | None = None
) -> DataFrame:
    """Archived responses of a feed, streamed or compacted; none before the first arrives.

    ``since`` prunes to arrivals from that date on; responses of unknown arrival stay.
    """
    streamed = _stored(spark, archive_path(archive, feed))
    compacted = _stored(spark, compacted_path(archive, feed))
    if streamed is None and compacted is None:
        responses = spark.createDataFrame([], f"{_ARCHIVE_SCHEMA}, ingest_date date")
    elif compacted is None:
        responses = streamed
    elif streamed is None:
        responses = compacted
    else:
        files = compacted.select("landed_file").distinct()
        fresh = streamed.join(files, "landed_file", "left_anti")
        columns = (*ARCHIVED, "ingest_date")
        responses = compacted.select(*columns).unionByName(fresh.select(*columns))
    responses = responses.withColumn("feed", F.lit(feed))
    if since is not None:
        recent = F.col("ingest_date") >= F.lit(since)
        responses = responses.filter(recent | F.col("ingest_date").isNull())
    return responses
