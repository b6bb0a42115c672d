"""Connected components of a link table, with every step a shuffle over links.

Rounds of large-star and small-star (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): each node hands its larger neighbours, then its smaller ones, to the smallest
node it knows, until every node points at the smallest of its component. The number of rounds
grows with the logarithm of the longest chain. Each round is written to the shared folder, so
a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from wxengine.session import shared_dir


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Point neighbours at the smallest: larger ones at the smallest of all, or smaller ones."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    lowest = lowest.select("a", F.least("a", "m").alias("m"))
    joined = both.join(lowest, "a")
    if larger:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = lowest.select("a", F.col("m").alias("b"))
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    moved = moved.where(F.col("a") != F.col("b"))
    # Repeats are only dropped once a round; the large star makes none of single links.
    return moved if larger else moved.distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for each id that has a link to another; ids are 64-bit integers."""
    spark = links.sparkSession

    def stored(rows: DataFrame) -> tuple[DataFrame, tuple]:
        path = shared_dir(spark, "components")
        # The fingerprint that tells whether a round changed anything comes with its write.
        seen = Observation()
        pair: Column = F.xxhash64("a", "b") % F.lit(1 << 40)
        marked = rows.observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(pair).alias("s"), F.sum(F.abs(pair)).alias("t")
        )
        marked.write.parquet(path)
        return spark.read.schema("a bigint, b bigint").parquet(path), tuple(seen.get.values())

    now = links.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"))
    now, mark = stored(now.where(F.col("a") != F.col("b")).distinct())
    before = None
    while mark != before and mark[0]:
        before = mark
        now, mark = stored(_star(_star(now, larger=True), larger=False))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
