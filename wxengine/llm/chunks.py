"""Documents dealt into chunks of bounded size, for look-ups in tables that may be any size.

Terms repeat. A chunk of some megabytes of text has far fewer distinct terms than terms, so
each chunk asks a table once for each of its distinct terms: it hands in sorted lists of
them, by a hash of the term; the lists of all chunks with one hash meet in a group, where
equal terms are looked up together; the answers, in the order of the lists, come back by
chunk, and the chunk's documents are put together from them. Neither the table nor a
document's terms are broadcast or shuffled whole. Everything is shuffled compressed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHUNK_BYTES = 8 << 20
_LEAST_BYTES = 2 << 20


def with_chunks(
    docs: DataFrame, id_col: str, text_col: str, most: int = CHUNK_BYTES
) -> tuple[DataFrame, int]:
    """``docs`` with ``_chunk``, by a hash of id and text, and the number of chunks.

    Copies are spread evenly by the hash. Chunks have about ``most`` bytes of text; small inputs
    are cut finer, to use all cores.
    """
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    n = max(-(-total // most), min(2 * cores, -(-total // _LEAST_BYTES)), 1)
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), id_col, text_col), F.lit(n)).cast("int")
    return docs.withColumn("_chunk", chunk), n


def ragged_take(
    flat: np.ndarray, sizes: np.ndarray, index: np.ndarray, starts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Of runs that lie end to end, those at ``index``, end to end, and their sizes.

    ``starts`` are where the runs start, for callers that take from the same runs again.
    """
    if starts is None:
        starts = np.cumsum(sizes) - sizes
    taken = sizes[index]
    first = np.repeat(starts[index] - (np.cumsum(taken) - taken), taken)
    return flat[first + np.arange(taken.sum())], taken


def bucket_count(chunks: int) -> int:
    """So many buckets that the lists of one, from all chunks, are a fraction of a chunk."""
    return max(64, 4 * chunks)


def bucket_of(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def packed_chunks(rows: DataFrame) -> DataFrame:
    """(_chunk, rows): the rows of each batch by chunk, as compressed Arrow streams."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            chunk = batch.column("_chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=-1))
            found = []
            for a, b in pairwise(cuts.tolist()):
                own = batch.take(pa.array(order[a:b]))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=options) as stream:
                    stream.write_batch(own)
                found.append((int(chunk[order[a]]), sink.getvalue().to_pybytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
                names=["_chunk", "rows"],
            )

    return rows.mapInArrow(pack, "_chunk int, rows binary")


def unpacked_chunk(table: pa.Table) -> Iterator[pa.Table]:
    for value in table.column("rows"):
        yield pa.ipc.open_stream(value.as_buffer()).read_all()
