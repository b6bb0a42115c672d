"""Words of UTF-8 texts in Arrow batches, as numpy arrays.

Texts arrive as binary columns. Word classes are sets of bytes; every byte of a character
outside ASCII must fall on one side, so that working on bytes equals working on characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from wxengine.llm.memory import give_back

PIECE_BYTES = 1 << 22
_SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

# A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Everything but space and \x09-\x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# Digits, letters, and everything outside ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
ALPHANUMERIC[128:] = True


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text; none for a null."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Pieces:
    """Some texts end to end: bytes, and where each text starts and ends in them."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, Pieces]]:
    """Cut a binary column into runs of texts of about ``most`` bytes, with their first row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(len(column), max(last, first + 1))
        cut = at[first : last + 1] - at[first]
        yield first, Pieces(raw[at[first] : at[last]], cut[:-1], cut[1:])
        first = last


@dataclass
class Words:
    """Words of some texts: hash, place in the bytes, and the texts' bounds among the words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray


def words(piece: Pieces, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes in each text, lower-cased in A-Z and hashed to 64 bits.

    The hash is a polynomial over a word's bytes, taken from running sums over all bytes,
    so that the cost is a few numpy passes whatever the number of words.
    """
    inside = is_word[piece.data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[piece.starts[piece.starts < len(inside)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[piece.ends[piece.ends > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        low = starts[done]
        upto = max(done + 1, int(np.searchsorted(ends, low + _SEGMENT, side="right")))
        high = ends[upto - 1]
        power = _powers(_BASE, high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        part = LOWER[piece.data[low:high]].astype(np.uint64) + np.uint64(1)
        np.cumsum(part * power[:-1], out=sums[1:])
        a, b = starts[done:upto] - low, ends[done:upto] - low
        hashes[done:upto] = mix((sums[b] - sums[a]) * _powers(_INVERSE, high - low + 1)[a])
        done = upto
    return Words(
        hashes,
        starts,
        ends,
        np.searchsorted(starts, piece.starts),
        np.searchsorted(starts, piece.ends),
    )


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; it also depends on ``size``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for i in range(size):
        total = total * _BASE + hashes[i : i + n]
    return mix(total)


def slices(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of about ``most`` bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in pairwise(cuts):
        if a < b:
            yield batch.slice(a, b - a)


def map_batches(
    frame: DataFrame,
    schema: str,
    function: Callable[[pa.RecordBatch], Iterator[dict[str, list | np.ndarray | pa.Array]]],
) -> DataFrame:
    """``mapInArrow`` with a function that yields columns by name for each batch."""
    # The result's schema is known to Spark; here it is only needed to build typed batches.
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in function(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        value if isinstance(value, pa.Array) else pa.array(value, type=field.type)
                        for field, value in ((f, out[f.name]) for f in arrow)
                    ],
                    schema=arrow,
                )
        give_back()

    return frame.mapInArrow(run, schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def _arrow_schema(schema: str) -> pa.Schema:
    fields = [part.strip().split(" ", 1) for part in schema.split(",")]
    return pa.schema([(name, _ARROW[kind]) for name, kind in fields])
