"""A table's log of runs: how far the table goes after each.

A run writes its entry, under the run's number, when everything else is written. What a run
that failed has left in the table is beyond the last entry; the next run writes it anew. A
run that is repeated under its number starts from the entry before it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from wxengine.sources.files import delete, exists, subfolders

_KEPT = 16


@dataclass(frozen=True)
class Mark:
    """Latest time of all readings up to a run; None where there was no reading."""

    number: int
    at: dt.datetime | None


def log_of(table: str) -> str:
    return f"{table.rstrip('/')}.runs"


def _numbers(spark: SparkSession, log: str) -> list[int]:
    names = (name.removeprefix("run=") for name in subfolders(spark, log))
    # An entry without its success file was not written to its end.
    return sorted(int(n) for n in names if exists(spark, f"{log}/run={n}/_SUCCESS"))


def last_mark(spark: SparkSession, log: str, before: int | None = None) -> Mark | None:
    """The newest entry, or the newest of a smaller number; None where there is none."""
    numbers = [n for n in _numbers(spark, log) if before is None or n < before]
    if not numbers:
        return None
    row = spark.read.schema("at timestamp_ntz").parquet(f"{log}/run={numbers[-1]}").first()
    return Mark(numbers[-1], row[0] if row else None)


def write_mark(spark: SparkSession, log: str, mark: Mark) -> None:
    """Write an entry, replacing one of the same number; old entries go."""
    at = F.lit(mark.at.isoformat() if mark.at else None).cast("timestamp_ntz")
    entry = spark.range(1).select(at.alias("at")).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{log}/run={mark.number}")
    for number in _numbers(spark, log)[:-_KEPT]:
        delete(spark, f"{log}/run={number}")
