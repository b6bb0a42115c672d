"""The few file-system calls that DataFrames lack, through the session's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none where there is no such folder."""
    files, place = _opened(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _opened(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _opened(spark, path)
    files.delete(place, True)
