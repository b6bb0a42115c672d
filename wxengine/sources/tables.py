"""Stored Parquet tables of a layer, partitioned by date."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wxengine.sources.files import delete, subfolders

PARTITION = "measure_date"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table was ever written, be it without rows."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        # A partitioned table without rows has no file to take a schema from.
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return True


def read_dated(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table with its partition column; None where no row is stored."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table without its partition column; None where no row is stored."""
    stored = read_dated(spark, path)
    return None if stored is None else stored.drop(PARTITION)


def read_dates(
    spark: SparkSession, path: str, first: dt.date, last: dt.date | None = None
) -> DataFrame | None:
    """Stored rows of some dates; no other date is read."""
    stored = read_dated(spark, path)
    return None if stored is None else stored.filter(on_dates(first, last)).drop(PARTITION)


def on_dates(first: dt.date, last: dt.date | None = None) -> Column:
    """Partitions from one date to another, as literals, so that files are pruned."""
    dates = F.col(PARTITION) >= F.lit(first)
    return dates if last is None else dates & (F.col(PARTITION) <= F.lit(last))


def _write(rows: DataFrame, path: str, mode: str, at: str, overwrite: str) -> None:
    """The rebalance splits a date that is too big for one task."""
    (
        rows.withColumn(PARTITION, F.col(at).cast("date"))
        .hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, "station_id", at)
        .write.mode(mode)
        .option("partitionOverwriteMode", overwrite)
        .partitionBy(PARTITION)
        .parquet(path)
    )


def write_table(rows: DataFrame, path: str, mode: str, at: str = "measure_at") -> None:
    """Write time-series rows partitioned by date and clustered by station."""
    _write(rows, path, mode, at, "static")


def replace_dates(rows: DataFrame, path: str, at: str = "measure_at") -> None:
    """Write the dates that ``rows`` has; all other dates stay as they are, file by file.

    ``rows`` may read the table itself: new files replace the old ones at the end.
    """
    _write(rows, path, "overwrite", at, "dynamic")


def append_after(
    rows: DataFrame,
    path: str,
    first: dt.date,
    last: dt.date,
    kept: Column,
    at: str = "measure_at",
) -> None:
    """Write ``rows``, all of them of the date ``first`` or later, as what follows ``kept``.

    ``kept`` holds for the stored rows that runs before this one have written, none of them
    later than ``last``. Dates from ``first`` on are written anew from those and ``rows``, so
    a repeated run leaves no second copy, and what a failed run has left goes.
    """
    spark = rows.sparkSession
    for name in _date_folders(spark, path):
        if name > f"{PARTITION}={last.isoformat()}":
            delete(spark, f"{path}/{name}")
    stored = read_dated(spark, path)
    if stored is not None:
        rows = stored.filter(on_dates(first) & kept).drop(PARTITION).unionByName(rows)
    replace_dates(rows, path, at)


def _date_folders(spark: SparkSession, path: str) -> list[str]:
    names = subfolders(spark, path)
    return [n for n in names if n.startswith(f"{PARTITION}=") and not n.endswith("__")]


def high_water_mark(spark: SparkSession, path: str, at: str = "measure_at") -> dt.datetime | None:
    """Latest stored time over all stations; None for a table without rows.

    The folders' names tell the newest date, so only its files are read.
    """
    for name in reversed(_date_folders(spark, path)):
        try:
            newest = spark.read.parquet(f"{path}/{name}").agg(F.max(at)).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            continue
        if newest is not None:
            return newest
    return None


def newer_than(rows: DataFrame, mark: dt.datetime | None, at: str = "measure_at") -> DataFrame:
    """Rows after the mark. Without a mark there is nothing to compare with: no rows."""
    if mark is None:
        return rows.filter(F.lit(False))
    return rows.filter(F.col(at) > at_literal(mark))


def at_literal(time: dt.datetime) -> Column:
    return F.lit(time.isoformat()).cast("timestamp_ntz")
