"""Near-duplicate embeddings: Euclidean p-stable hashing, then exact cosines.

Vectors are scaled to length one and projected on Gaussian directions. A table's key is the
``PROJECTIONS`` projections, each shifted by a random offset and cut into steps of ``WIDTH``;
vectors that share the key of at least one of ``TABLES`` tables are compared exactly, in
double precision. At cosine 0.9 a projection agrees with probability 0.80, so a pair at the
very threshold is missed with probability (1 - 0.80^8)^40, about 0.04 %, and a closer one
with less.

Equal vectors are compared once, as a class with a number of members. Buckets are compared in
tasks of bounded size (``groups``). A pair counts in the first table whose keys agree, so no
list of pairs is needed: tasks return numbers of links, and the links that join components.

Edge cases. Vectors that are null, empty, zero, or have a null or non-finite component link
with nothing and are components of their own; vectors of different lengths never link. Ties
do not matter. Rows that repeat an id are vectors like any other: each row is returned, and
rows of one id with equal vectors link as others do. An id that is null gets no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wxengine.llm.components import components
from wxengine.llm.groups import Links, comparison_tasks, run_tasks, sides
from wxengine.session import shared_dir

COSINE = 0.9
PROJECTIONS = 8
TABLES = 40
WIDTH = 1.79
BLOCK = 1500
_SEED = 11


@cache
def _family(size: int, projections: int, tables: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([_SEED, size])
    directions = random.standard_normal((size, projections * tables)) / width
    return directions, random.random(projections * tables)


def _mixed(steps: np.ndarray, projections: int, tables: int) -> np.ndarray:
    """One 64-bit key for each table from the steps of its projections."""
    keys = np.full((len(steps), tables), 0x9E3779B97F4A7C15, dtype=np.uint64)
    cut = steps.reshape(len(steps), tables, projections).astype(np.int64).view(np.uint64)
    for i in range(projections):
        keys = (keys ^ cut[:, :, i]) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def keys_of(vectors: np.ndarray, projections: int, tables: int, width: float) -> np.ndarray:
    directions, offsets = _family(vectors.shape[1], projections, tables, width)
    return _mixed(np.floor(unit(vectors) @ directions + offsets), projections, tables)


def link_embeddings(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    projections: int = PROJECTIONS,
    tables: int = TABLES,
    width: float = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    spark = embeddings.sparkSession
    vector = F.col("_vector")
    sound = (
        (F.size(vector) > 0)
        & F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        )
        & F.exists(vector, lambda x: x != 0)
    )
    rows = embeddings.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vector")).withColumn(
        "_sound", F.coalesce(sound, F.lit(False))
    )
    # 0.0 and -0.0 are one value to a cosine and two to a hash.
    same = F.transform("_vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.withColumn("_digest", F.when(F.col("_sound"), F.sha2(F.to_json(F.struct(same)), 256)))
    path = shared_dir(spark, "embeddings")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)

    classes = (
        rows.where("_sound and _id is not null")
        .groupBy("_digest")
        .agg(F.min(F.struct("_id", "_vector")).alias("_first"), F.count("*").alias("_copies"))
        .select(
            "_digest",
            F.col("_first._id").alias("_rep"),
            F.col("_first._vector").alias("_vector"),
            "_copies",
        )
    )
    class_path = shared_dir(spark, "embedding-classes")
    classes.withColumn("_class", F.xxhash64("_digest")).write.parquet(class_path)
    classes = spark.read.parquet(class_path)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, part in frame.groupby(frame["_vector"].map(len)):
                vectors = np.stack(part["_vector"].to_numpy()).astype(np.float64)
                keys = keys_of(vectors, projections, tables, width)
                n = len(part)
                yield pd.DataFrame(
                    {
                        "_table": np.tile(np.arange(tables), n),
                        "_key": keys.ravel(),
                        "_size": size,
                        "_digest": np.repeat(part["_digest"].to_numpy(), tables),
                    }
                )

    buckets = classes.select("_vector", "_digest").mapInPandas(
        hashed, "_table int, _key bigint, _size int, _digest string"
    )
    # Most keys have one vector; only those of shared keys carry vectors on.
    shared = comparison_tasks(buckets, ["_table", "_key", "_size"], "_digest", block)
    tasks = shared.join(classes.select("_digest", "_rep", "_copies", "_vector"), "_digest")

    def compare(rows: pd.DataFrame, bounds: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        sizes = rows["_size"].to_numpy()
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            vectors = np.stack(rows["_vector"].to_numpy()[own])
            keys = keys_of(vectors, projections, tables, width)
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            # Tasks are on one size, so their rows stay together.
            starts = np.searchsorted(own, [a for a, _ in bounds if sizes[a] == size])
            ends = [*starts[1:].tolist(), len(own)]
            part = rows.iloc[own]
            table, side = part["_table"].to_numpy(), part["_side"].to_numpy()
            reps, copies = part["_rep"].to_numpy(), part["_copies"].to_numpy()
            digests = part["_digest"].to_numpy()
            out: list[tuple] = []
            for a, b in zip(starts.tolist(), ends, strict=True):
                left, right = sides(side[a:b])
                cosines = (vectors[a:b][left] @ vectors[a:b][right].T) / np.outer(
                    lengths[a:b][left], lengths[a:b][right]
                )
                near = cosines >= cosine
                if left is right:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                i, j = left[i], right[j]
                if table[a]:
                    earlier = keys[a:b, : table[a]]
                    first = np.fromiter(
                        (not (earlier[x] == earlier[y]).any() for x, y in zip(i, j, strict=True)),
                        bool,
                        len(i),
                    )
                    i, j = i[first], j[first]
                if not len(i):
                    continue
                links = Links(reps[a:b].tolist())
                links.join_all(i, j)
                counts = np.bincount(i, copies[a:b][j], b - a) + np.bincount(j, copies[a:b][i], b - a)
                for k in np.flatnonzero(counts).tolist():
                    parent = links.ids[links.label[k]]
                    out.append((digests[a + k], int(counts[k]), int(reps[a + k]), int(parent)))
            yield pd.DataFrame(out, columns=["_digest", "_links", "a", "b"])

    found = run_tasks(tasks, compare, "_digest string, _links bigint, a bigint, b bigint")
    found_path = shared_dir(spark, "embedding-links")
    found.write.parquet(found_path)
    found = spark.read.parquet(found_path)
    linked = components(found)
    counts = found.groupBy("_digest").agg(F.sum("_links").alias("_links"))
    named = (
        classes.join(linked, F.col("_rep") == F.col("id"), "left")
        .join(counts, "_digest", "left")
        .select("_digest", "_rep", "_copies", "component", "_links")
    )
    joined = rows.join(named, "_digest", "left")
    component = F.coalesce("component", "_rep", "_id")
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_id").isNull(), F.lit(0))
        .otherwise(F.coalesce(F.col("_copies") - 1, F.lit(0)) + F.coalesce("_links", F.lit(0)))
        .alias("n_links"),
        F.when(F.col("_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
    )
