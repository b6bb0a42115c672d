"""File-landing stream and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wxengine.operators.dedup import latest_per_key
from wxengine.sources.files import delete, exists, subfolders
from wxengine.sources.landing import WHOLE_VARIANTS, archive_path, stream_landing, with_arrival


def ingest(
    spark: SparkSession,
    landing: str,
    archive: str,
    feed: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Archive all files that have arrived since the last run, each exactly once."""
    responses = stream_landing(spark, landing, max_files_per_trigger)
    return (
        with_arrival(responses)
        .writeStream.format("parquet")
        .options(**WHOLE_VARIANTS)
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
        .trigger(availableNow=True)
        .start(archive_path(archive, feed))
    )


def apply_batches(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand each batch of new rows to ``apply`` with its number.

    After a failure a batch comes again under the same number, with the same rows.
    """
    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )


def append_rows(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a Parquet table, each exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def write_versions(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    keys: tuple[str, ...] | None = None,
    fold_after: int = 16,
) -> StreamingQuery:
    """Store the rows a batch changed under the batch's number.

    A repeated batch replaces its own folder, so a restart leaves no second copy. With
    ``keys``, batches before the newest are folded into one base of newest versions when
    there are more than ``fold_after``, so that reading touches the base and a short tail.
    """
    spark = rows.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        store_version(spark, batch, batch_id, target, keys, fold_after=fold_after)

    return (
        rows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )


def store_version(
    spark: SparkSession,
    batch: DataFrame,
    number: int,
    target: str,
    keys: tuple[str, ...] | None = None,
    order: tuple[str, ...] = ("batch_id",),
    fold_after: int = 16,
) -> None:
    """Store rows under a batch's number; fold the batches before it when they are many."""
    batch.write.mode("overwrite").parquet(f"{target}/batch_id={number}")
    if keys and len(_tail(spark, target)) > fold_after:
        fold_versions(spark, target, keys, order, before=number)


def _base(spark: SparkSession, target: str) -> int:
    """Number of the last batch in the newest complete base, -1 without one."""
    names = [n for n in subfolders(spark, target) if n.startswith("through=")]
    done = [int(n.removeprefix("through=")) for n in names if exists(spark, f"{target}/{n}/_SUCCESS")]
    return max(done, default=-1)


def _tail(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the batches that are not in the base."""
    base = _base(spark, target)
    names = (n for n in subfolders(spark, target) if n.startswith("batch_id="))
    return sorted(n for n in (int(name.removeprefix("batch_id=")) for name in names) if n > base)


def _versions(spark: SparkSession, target: str, before: int | None) -> DataFrame:
    base, tail = _base(spark, target), _tail(spark, target)
    paths = [f"{target}/batch_id={n}" for n in tail if before is None or n < before]
    parts = []
    if base >= 0:
        parts.append(spark.read.parquet(f"{target}/through={base}").withColumn("batch_id", F.lit(base)))
    if paths:
        parts.append(spark.read.option("basePath", target).parquet(*paths))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def newest_version(
    spark: SparkSession,
    target: str,
    keys: tuple[str, ...],
    order: tuple[str, ...] = ("batch_id",),
    before: int | None = None,
) -> DataFrame:
    """The last stored version of each row written by ``write_versions``."""
    return latest_per_key(_versions(spark, target, before), keys, order).drop("batch_id")


def fold_versions(
    spark: SparkSession,
    target: str,
    keys: tuple[str, ...],
    order: tuple[str, ...] = ("batch_id",),
    before: int | None = None,
) -> None:
    """Fold the batches before a number into a new base, and delete what it replaces.

    The batch of that number may come again and stays. A base counts once it is complete;
    folders that an interrupted fold has left are no longer read and go with the next one.
    """
    through = max((n for n in _tail(spark, target) if before is None or n < before), default=None)
    if through is None:
        return
    folded = newest_version(spark, target, keys, order, through + 1)
    folded.write.mode("overwrite").parquet(f"{target}/through={through}")
    for name in subfolders(spark, target):
        kind, _, number = name.partition("=")
        if (kind == "through" and int(number) < through) or (kind == "batch_id" and int(number) <= through):
            delete(spark, f"{target}/{name}")
