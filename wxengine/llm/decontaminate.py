"""Benchmark passages in training documents: windows of 13 words looked up in a hash set.

A word is a run of letters and digits (everything outside ASCII counts as such), lower-cased
in A-Z. An item's windows are its runs of 13 consecutive words; an item with fewer words, but
some, is one window. Document words inside any occurrence of a window are hit.

The set of windows is broadcast while it has at most ``BROADCAST_WINDOWS`` of them. A larger
benchmark is cut into several sets that are looked up one after the other, each over all
documents, with what is found so far stored in between; the result is the same.

Edge cases. A null or empty text has no words, so it is never contaminated. A null, empty or
wordless item has no windows. Repeated items with one id count once; repeated documents each
get a row. With no items at all nothing is hit. Columns other than the id and the text are
not looked at; ``remove`` returns all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from wxengine.llm.arrow_text import (
    ALPHANUMERIC,
    Pieces,
    map_batches,
    pieces,
    utf8,
    windows,
    words,
)
from wxengine.session import shared_dir

WINDOW = 13
BROADCAST_WINDOWS = 2_000_000
_FILTER_BITS = 22


def item_windows(
    items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW
) -> DataFrame:
    """Distinct (item, n_words, hash, content) of all windows; content is the words in UTF-8."""
    rows = items.select(
        F.col(item_col).cast("string").alias("item"), utf8(F.col(text_col)).alias("text")
    ).where(F.col("item").isNotNull())

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        names = batch.column(0)
        for first, piece in pieces(batch.column(1)):
            found = words(piece, ALPHANUMERIC)
            out: dict[str, list] = {"item": [], "n_words": [], "hash": [], "content": []}
            for i, (a, b) in enumerate(zip(found.first, found.last, strict=True)):
                n = min(size, int(b - a))
                if n == 0:
                    continue
                hashes = windows(found.hashes[a:b], n).view(np.int64)
                out["item"] += [names[first + i].as_py()] * len(hashes)
                out["n_words"] += [n] * len(hashes)
                out["hash"] += hashes.tolist()
                out["content"] += [_content(piece, found, a + k, n) for k in range(len(hashes))]
            yield out

    return map_batches(
        rows, "item string, n_words int, hash bigint, content binary", cut
    ).distinct()


def _content(piece: Pieces, found, first: int, n: int) -> bytes:
    return b" ".join(
        piece.data[found.starts[k] : found.ends[k]].tobytes().lower()
        for k in range(first, first + n)
    )


class WindowSet:
    """Windows by hash, with the items that hold each and its words for the exact check."""

    def __init__(self, rows: list) -> None:
        self.by_size: dict[int, np.ndarray] = {}
        self.entries: dict[tuple[int, int], list[tuple[bytes, str]]] = {}
        for row in rows:
            key = (row["n_words"], row["hash"])
            self.entries.setdefault(key, []).append((bytes(row["content"]), row["item"]))
        for size in {n for n, _ in self.entries}:
            keys = np.array([h for n, h in self.entries if n == size], dtype=np.int64)
            self.by_size[size] = np.sort(keys.view(np.uint64))
        # A bit for each hash's top bits settles nearly every look-up with one memory access.
        self.filters = {}
        for size, keys in self.by_size.items():
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
            bits[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters[size] = bits

    def hits(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Positions whose window hash is in the set."""
        maybe = np.flatnonzero(self.filters[size][hashes >> np.uint64(64 - _FILTER_BITS)])
        keys = self.by_size[size]
        at = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
        return maybe[keys[at] == hashes[maybe]]


def _scan(piece: Pieces, windows_set: WindowSet) -> Iterator[tuple[int, list[dict], set[str]]]:
    """For each text: number of words, hit stretches, and the items whose windows occur."""
    found = words(piece, ALPHANUMERIC)
    texts: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for size in sorted(windows_set.by_size):
        hashes = windows(found.hashes, size)
        if not len(hashes):
            continue
        for k in windows_set.hits(hashes, size).tolist():
            text = int(np.searchsorted(found.last, k, side="right"))
            if k + size > found.last[text]:
                continue  # it runs over the end of its text
            own = _content(piece, found, k, size)
            key = (size, int(hashes[k].view(np.int64)))
            items = {item for content, item in windows_set.entries[key] if content == own}
            if items:
                stretches, names = texts.setdefault(text, ([], set()))
                stretches.append((k, k + size))
                names |= items
    for i, (a, b) in enumerate(zip(found.first.tolist(), found.last.tolist(), strict=True)):
        stretches, names = texts.get(i, ([], set()))
        hits = [
            {
                "first": p - a,
                "last": q - a,
                "start": int(found.starts[p] - piece.starts[i]),
                "end": int(found.ends[q - 1] - piece.starts[i]),
            }
            for p, q in _merged(stretches)
        ]
        yield b - a, hits, names


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_HIT = "struct<first:bigint,last:bigint,start:bigint,end:bigint>"
_FOUND = f"struct<n_words:bigint,hits:array<{_HIT}>,items:array<string>>"
_ARROW_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        (
            "hits",
            pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])),
        ),
        ("items", pa.list_(pa.string())),
    ]
)


def lookup(text: Column, windows_set: Broadcast) -> Column:
    """Words of a text, its hit stretches (in words, and in bytes of UTF-8), and items."""

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array(
            [
                {"n_words": n, "hits": hits, "items": sorted(names)}
                for _, piece in pieces(texts)
                for n, hits, names in _scan(piece, windows_set.value)
            ],
            type=_ARROW_FOUND,
        )

    return found(utf8(text))


def with_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct column ``_found``: n_words, hits and items over all windows."""
    spark = docs.sparkSession
    stored = item_windows(items, item_col, item_text_col)
    total = stored.count()
    parts = -(-total // broadcast_windows) or 1
    out = docs
    for part in range(parts):
        own = stored.where(F.pmod(F.xxhash64("hash"), F.lit(parts)) == part)
        windows_set = spark.sparkContext.broadcast(WindowSet(own.collect()))
        found = lookup(F.col(text_col), windows_set)
        if part == 0:
            out = out.withColumn("_found", found)
        else:
            # One set in memory at a time: what is found so far is stored first.
            path = shared_dir(spark, "decontaminate")
            out.write.parquet(path)
            out = spark.read.parquet(path).withColumn("_more", found)
            out = out.withColumn(
                "_found",
                F.struct(
                    F.col("_found.n_words").alias("n_words"),
                    F.concat("_found.hits", "_more.hits").alias("hits"),
                    F.array_union("_found.items", "_more.items").alias("items"),
                ),
            ).drop("_more")
    return out


def merged_hits() -> Column:
    """The stretches of ``_found`` in order, overlapping and touching ones put together."""
    last = F.element_at

    def add(done: Column, hit: Column) -> Column:
        top = last(done, -1)
        joined = F.struct(
            top["first"].alias("first"),
            F.greatest(top["last"], hit["last"]).alias("last"),
            top["start"].alias("start"),
            F.greatest(top["end"], hit["end"]).alias("end"),
        )
        overlaps = (F.size(done) > 0) & (hit["first"] <= F.try_element_at(done, F.lit(-1))["last"])
        return F.when(
            overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        ).otherwise(F.concat(done, F.array(hit)))

    empty = F.array().cast(f"array<{_HIT}>")
    return F.aggregate(F.array_sort(F.col("_found.hits")), empty, add)


def _measured(found: DataFrame) -> DataFrame:
    hit = F.aggregate(
        F.col("_hits"), F.lit(0).cast("bigint"), lambda n, h: n + h["last"] - h["first"]
    )
    return (
        found.withColumn("_hits", merged_hits())
        .withColumn("_n_words", F.col("_found.n_words"))
        .withColumn("_n_hit", hit)
        .withColumn("_contaminated", (F.col("_n_hit") > 0) & (F.col("_n_hit") * 20 >= F.col("_n_words")))
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Per document: n_words, n_hit, items, hits, contaminated (n_hit at least a twentieth)."""
    found = _measured(with_hits(docs.select(id_col, text_col), items, text_col, **options))
    return found.select(
        id_col,
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.array_sort(F.col("_found.items")).alias("items"),
        F.col("_hits").alias("hits"),
        F.col("_contaminated").alias("contaminated"),
    )


def remove(
    docs: DataFrame, items: DataFrame, what: str = "documents", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without contaminated documents, or with every hit stretch cut out of its text."""
    found = _measured(with_hits(docs, items, text_col, **options))
    if what == "documents":
        return found.where(~F.col("_contaminated")).select(*docs.columns)
    if what != "spans":
        raise ValueError(f"what is documents or spans, not {what!r}")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for text, stretches in zip(texts, hits, strict=True):
            value, done, kept = text.as_py(), 0, []
            for hit in stretches.as_py() or ():
                kept.append(value[done : hit["start"]])
                done = hit["end"]
            out.append(None if value is None else b"".join([*kept, value[done:]]).decode())
        return pa.array(out, type=pa.string())

    clean = F.when(F.size("_hits") > 0, cut(F.col(text_col).cast("binary"), F.col("_hits")))
    return found.withColumn(text_col, F.coalesce(clean, F.col(text_col))).select(*docs.columns)
