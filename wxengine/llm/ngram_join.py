"""Documents that share most of their 3-word shingles: an exact join over signature trees.

Two documents link when their sets of shingles have a Jaccard similarity of at least
``PERCENT`` / 100. The result is exact but for collisions of 64-bit shingle hashes.

1. Documents with equal sets are one class, found by a digest of the set.
2. Sets that link must share one of their first ``size - ceil(t * size) + 1`` shingles in any
   common order. Rare shingles come first: by the count of their hash's bucket in a sketch of
   65,536 counters over all documents (broadcast; its size is fixed), then by hash. So what
   very many documents have in common hardly ever brings documents together.
3. Classes that share such a shingle, and whose sizes allow a link, are joined in a signature
   tree: leaves hold bitmaps of the sets, inner nodes the OR of their children's bitmaps and
   their range of sizes. Two nodes are visited together only when the bits they share, and
   the shingles that bits may hide, leave room for enough overlap. What survives at the
   leaves joins classes to candidate families.
4. In each family the sets themselves are joined by the same dual traversal, over bitmaps
   with one bit for each shingle of at least two members. Bits shared are then shingles
   shared, so what survives is a link.
5. Links join classes to components.

Groups of any size are compared in tasks of bounded size (``groups``), which return one edge
per class they join and never a list of pairs.

Edge cases. A null, empty or wordless text has no shingles and is a component of its own.
With one or two words the whole sequence is the one shingle. Repeated rows are each returned,
and equal texts belong to one component. A row without an id links with nothing and has no
component. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from wxengine.llm.arrow_text import NOT_SPACE, map_batches, pieces, utf8, windows, words
from wxengine.llm.components import components
from wxengine.llm.groups import Links, comparison_tasks, run_tasks, sides
from wxengine.session import shared_dir

SHINGLE = 3
PERCENT = 90
_SKETCH_BITS = 16
_LEAF = 16
_FANOUT = 8
# Members of a comparison task: classes when only bitmaps are compared, shingles for sets.
_SIGNATURES = 2_000
_SHINGLES = 1_000_000


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    for _, piece in pieces(texts):
        found = words(piece, NOT_SPACE)
        hashes = windows(found.hashes, size)
        for a, b in zip(found.first.tolist(), found.last.tolist(), strict=True):
            if b - a >= size:
                yield np.unique(hashes[a : b - size + 1])
            else:
                yield windows(found.hashes[a:b], b - a) if b > a else np.empty(0, np.uint64)


def least_overlap(size_a, size_b, percent: int):
    """Smallest overlap at which sets of these sizes link: 100 * o >= percent * union."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def _sketch(rows: DataFrame, size: int) -> np.ndarray:
    """Counts of the shingles of all documents by the top bits of their hashes."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        total = np.zeros(1 << _SKETCH_BITS, dtype=np.int64)
        for own in shingle_sets(batch.column(0), size):
            total += np.bincount(own >> np.uint64(64 - _SKETCH_BITS), minlength=len(total))
        buckets = np.flatnonzero(total)
        yield {"bucket": buckets, "n": total[buckets]}

    counted = map_batches(rows.select("_text"), "bucket bigint, n bigint", count)
    sketch = np.zeros(1 << _SKETCH_BITS, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sketch[row["bucket"]] = row["n"]
    return sketch


def _width(n: int, percent: int) -> int:
    """Bits for the bitmap of a set: a power of two, so it can fold, of half its size or more.

    Sets of two shingles a bit leave room for 0.94 of their size in common even where they have
    nothing to do with each other, those of one a bit for 0.77.
    """
    halved = 200 * percent > 94 * (100 + percent)
    return 1 << max(6, (n - 1).bit_length() - halved)


def _bitmap(shingles: np.ndarray, percent: int) -> bytes:
    """The set in bits by its shingles' lowest bits."""
    width = _width(len(shingles), percent)
    bits = np.zeros(width, dtype=bool)
    bits[shingles & np.uint64(width - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _signatures(rows: DataFrame, sketch: Broadcast, size: int, percent: int) -> DataFrame:
    """Per document: set size, digest, prefix keys (smallest hash first), and bitmap."""

    def sign(batch: pa.RecordBatch) -> Iterator[dict]:
        level = np.frexp(sketch.value.astype(float))[1]
        out: dict[str, list] = {c: [] for c in ("size", "digest", "keys", "bits")}
        for own in shingle_sets(batch.column("_text"), size):
            n = len(own)
            out["size"].append(n)
            out["digest"].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            # Sets of at most this size only link with equal ones.
            if n == 0 or least_overlap(n, n + 1, percent) > n:
                out["keys"].append([])
                out["bits"].append(b"")
                continue
            rare = np.lexsort((own, level[own >> np.uint64(64 - _SKETCH_BITS)]))
            prefix = np.sort(own[rare[: n - -(-percent * n // 100) + 1]])
            out["keys"].append(prefix.view(np.int64))
            out["bits"].append(_bitmap(own, percent))
        yield {"_id": batch.column("_id"), **out}

    kind = rows.schema["_id"].dataType.simpleString()
    return map_batches(
        rows, f"_id {kind}, size bigint, digest binary, keys array<bigint>, bits binary", sign
    )


class Tree:
    """Levels of nodes over some rows, leaves first: OR of bits, range of sizes, excess.

    A set's excess is its size less its bits: the shingles that share a bit with another.
    """

    def __init__(self, rows: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> None:
        self.rows = rows[np.lexsort((bits[rows, 0], sizes[rows]))]
        bits, sizes = bits[self.rows], sizes[self.rows]
        excess = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, excess)]
        fanout = _LEAF
        while len(self.levels[-1][0]) > 1:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(bits), fanout)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(excess, at),
                )
            )
            fanout = _FANOUT


def _possible(one: tuple, two: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs may hold a link, by the largest overlap that their bits leave room for.

    Common shingles lie on common bits. On those a set has at most one shingle each, and its
    excess.
    """
    (bits, low, high, excess), (bits_, low_, high_, excess_) = one, two
    most = np.bitwise_count(bits[i] & bits_[j]).sum(axis=1, dtype=np.int64)
    most += np.minimum(excess[i], excess_[j])
    most = np.minimum(most, np.minimum(high[i], high_[j]))
    larger = np.maximum(low[i], low_[j])
    return (most >= least_overlap(low[i], low_[j], percent)) & (100 * most >= percent * larger)


def join_trees(one: Tree, two: Tree, links: Links, percent: int) -> None:
    """Traverse two trees together, or one with itself, and join rows that may link."""
    same = one is two
    depth = max(len(one.levels), len(two.levels)) - 1
    words = one.levels[0][0].shape[1]
    chunk = max(1, (1 << 21) // (_LEAF * _LEAF * words))

    def visit(level: int, i: np.ndarray, j: np.ndarray) -> None:
        for start in range(0, len(i), chunk):
            a, b = i[start : start + chunk], j[start : start + chunk]
            sides_ = []
            for tree in (one, two):
                sides_.append(tree.levels[min(level, len(tree.levels) - 1)])
            if level == 0:
                apart = links.label[one.rows[a]] != links.label[two.rows[b]]
                a, b = a[apart], b[apart]
            good = _possible(*sides_, a, b, percent)
            a, b = a[good], b[good]
            if not len(a):
                continue
            if level == 0:
                links.join_all(one.rows[a], two.rows[b])
                continue
            below = []
            for tree, nodes in ((one, a), (two, b)):
                if level > len(tree.levels) - 1:
                    below.append((nodes, np.ones(len(nodes), dtype=np.int64)))
                    continue
                fanout = _LEAF if level == 1 else _FANOUT
                first = nodes * fanout
                below.append((first, np.minimum(fanout, len(tree.levels[level - 1][0]) - first)))
            (first_a, n_a), (first_b, n_b) = below
            total = n_a * n_b
            pair = np.repeat(np.arange(len(a)), total)
            within = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
            next_a = first_a[pair] + within // n_b[pair]
            next_b = first_b[pair] + within % n_b[pair]
            if same:
                upper = next_a < next_b if level == 1 else next_a <= next_b
                next_a, next_b = next_a[upper], next_b[upper]
            visit(level - 1, next_a, next_b)

    if len(one.rows) and len(two.rows) and not (same and len(one.rows) < 2):
        visit(depth, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))


def _folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    return np.stack(
        [
            np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 64), axis=0)
            for b in bitmaps
        ]
    )


def _candidates(percent: int):
    """Join the classes of a task whose bitmaps leave room for a link."""

    def join_one(links: Links, bitmaps: list[bytes], sizes: np.ndarray, side: np.ndarray) -> None:
        widths = np.array([len(b) * 8 for b in bitmaps])
        left, right = sides(side)
        for width in np.unique(widths):
            # Sets that link have bitmaps of one width, or one twice as wide.
            near = np.flatnonzero((widths == width) | (widths == 2 * width))
            bits = np.zeros((len(bitmaps), width // 64), dtype=np.uint64)
            bits[near] = _folded([bitmaps[k] for k in near], int(width))
            both = [
                [Tree(own[widths[own] == w], bits, sizes) for w in (width, 2 * width)]
                for own in ((left,) if left is right else (left, right))
            ]
            narrow, wide = both[0]
            if left is right:
                join_trees(narrow, narrow, links, percent)
                join_trees(narrow, wide, links, percent)
            else:
                join_trees(narrow, both[1][0], links, percent)
                join_trees(narrow, both[1][1], links, percent)
                join_trees(wide, both[1][0], links, percent)

    def join(rows: pd.DataFrame, bounds: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        reps, bitmaps = rows["rep"].to_numpy(), rows["bits"].to_numpy()
        sizes, side = rows["size"].to_numpy(), rows["_side"].to_numpy()
        family = rows["family"].to_numpy()
        for a, b in bounds:
            if (family[a:b] == family[a]).all():
                continue
            if not sizes_fit(sizes[a:b], percent):
                continue
            links = Links(reps[a:b].tolist())
            order = np.argsort(family[a:b], kind="stable")
            same = np.flatnonzero(family[a:b][order][1:] == family[a:b][order][:-1])
            links.join_all(order[same], order[same + 1])
            join_one(links, bitmaps[a:b].tolist(), sizes[a:b], side[a:b])
            x, y = links.star()
            if len(x):
                yield pd.DataFrame({"a": x, "b": y})

    return join


def sizes_fit(sizes: np.ndarray, percent: int) -> bool:
    """Whether any two of the sizes allow a link."""
    ascending = np.sort(sizes)
    return bool((100 * ascending[:-1] >= percent * ascending[1:]).any())


def _packed(rows: DataFrame) -> DataFrame:
    """The rows' ids and their texts compressed, as a text goes through two shuffles."""

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        compress = zstandard.ZstdCompressor(level=1).compress
        texts = (text.as_buffer() for text in batch.column("_text"))
        yield {"_id": batch.column("_id"), "_packed": [compress(text) for text in texts]}

    kind = rows.schema["_id"].dataType.simpleString()
    return map_batches(rows, f"_id {kind}, _packed binary", pack)


def _linked(percent: int, size: int):
    """Join the documents of a task whose shingle sets link."""

    def join(rows: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        texts = [expand(text.as_buffer()) for text in rows.column("_packed")]
        sets = list(shingle_sets(pa.array(texts, pa.large_binary()), size))
        del texts
        links = Links(rows.column("rep").to_pylist())
        sizes = np.array([len(own) for own in sets], dtype=np.int64)
        distinct, place, count = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        shared = count > 1
        column = np.cumsum(shared) - 1
        width = max(1, -(-int(shared.sum()) // 64))
        bits = np.zeros((len(sets), width), dtype=np.uint64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for k in range(len(sets)):
            own = place[bounds[k] : bounds[k + 1]]
            own = own[shared[own]]
            cells = np.zeros(width * 64, dtype=bool)
            cells[column[own]] = True
            bits[k] = np.packbits(cells, bitorder="little").view(np.uint64)
        left, right = sides(rows.column("_side").to_numpy())
        one = ExactTree(left, bits, sizes)
        two = one if left is right else ExactTree(right, bits, sizes)
        join_trees(one, two, links, percent)
        a, b = links.star()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return join


class ExactTree(Tree):
    """A tree over bitmaps with a bit for each shingle of two or more rows: nothing is hidden."""

    def __init__(self, rows: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> None:
        super().__init__(rows, bits, sizes)
        self.levels = [(b, low, high, np.zeros_like(e)) for b, low, high, e in self.levels]


def _stored(frame: DataFrame, label: str) -> DataFrame:
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _round(classes: DataFrame, keys: Column, percent: int) -> DataFrame:
    """Edges between classes of different families that share a key and may link."""
    rows = classes.select("rep", "family", "size", F.explode(keys).alias("key"))
    tasks = comparison_tasks(rows, ["key"], "rep", _SIGNATURES, mixed="family")
    # Bitmaps only go where the next smaller or larger set of the task allows a link.
    by_size = Window.partitionBy("_task").orderBy("size")
    smaller, larger = F.lag("size").over(by_size), F.lead("size").over(by_size)
    fits = (100 * smaller >= percent * F.col("size")) | (100 * F.col("size") >= percent * larger)
    tasks = tasks.withColumn("_fits", fits).where("_fits")
    tasks = tasks.select("rep", "family", "_task", "_side").join(
        classes.select("rep", "size", "bits"), "rep"
    )
    return run_tasks(tasks, _candidates(percent), "a bigint, b bigint")


def link_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (its smallest id)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("_id"), utf8(F.col(text_col)).alias("_text")
    )
    sketch = spark.sparkContext.broadcast(_sketch(rows, size))
    signed = _stored(_signatures(rows, sketch, size, percent), "shingles")
    known = signed.where("_id is not null and size > 0")
    reps = known.groupBy("digest").agg(F.min("_id").alias("rep"))
    # Joined by id alone, so that the grouping by id needs no shuffle of its own.
    classes = (
        known.where(F.size("keys") > 0)
        .join(reps.select(F.col("rep").alias("_id"), F.col("digest").alias("_digest")), "_id")
        .where("digest = _digest")
        .groupBy(F.col("_id").alias("rep"))
        .agg(*(F.first(c).alias(c) for c in ("size", "keys", "bits")))
    )
    classes = _stored(classes, "shingle-classes").withColumn("family", F.col("rep"))
    # A few keys bring most near copies together; the rest only has to be compared across.
    first = _stored(_round(classes, F.slice("keys", 1, 4), percent), "shingle-candidates")
    families = components(first)
    near = classes.join(families, F.col("rep") == F.col("id"), "left").select(
        "rep", "size", "keys", "bits", F.coalesce("component", "rep").alias("family")
    )
    second = _stored(_round(near, F.col("keys"), percent), "shingle-candidates")
    if not second.isEmpty():
        families = components(first.unionByName(second))
    families = families.select(F.col("id").alias("rep"), F.col("component").alias("family"))
    families = families.unionByName(families.select(F.col("family").alias("rep"), "family").distinct())
    members = families.join(classes.select("rep", "size"), "rep")
    weight = F.greatest(F.col("size"), F.lit(_SHINGLES // 1000))
    tasks = comparison_tasks(members, ["family"], "rep", _SHINGLES, weight)
    compared = (
        tasks.select("rep", "_task", "_side")
        .join(_packed(rows), F.col("rep") == F.col("_id"))
        .groupBy("_task")
        .applyInArrow(_linked(percent, size), "a bigint, b bigint")
    )
    linked = components(_stored(compared, "shingle-links")).withColumnRenamed("id", "rep")
    named = reps.join(linked, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("_component")
    )
    return signed.join(named, "digest", "left").select(
        F.col("_id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("_id"))
        .when(F.col("_id").isNotNull(), F.col("_component"))
        .alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Rows without an id stay. Rows that repeat an id are one document: they stay or go together.
    """
    linked = link_documents(docs, id_col, text_col, **options)
    gone = linked.where(F.col(id_col) != F.col("component_id")).select(id_col)
    kept = docs.join(gone.distinct(), id_col, "left_anti").select(*docs.columns)
    return kept
