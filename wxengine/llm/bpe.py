"""Byte-level BPE over a table of distinct words.

Texts are split into pre-tokens ("words", with the blank before them). Each distinct word is
encoded once: a chunk of documents hands in its distinct words, in sorted lists by a hash of
the word; equal words of all chunks meet in one group, which encodes each once; the answers
go back by chunk, where ids are joined to the words' positions, and the ids of each document
are joined to the id-to-piece table, whose bytes end to end are the decoded text. Documents,
lists and answers are shuffled compressed.

The tokenizer file is read on the driver and sent to the tasks, its size being that of the
vocabulary. Its added tokens are cut out of the text before splitting, as the library does.

Edge cases. A null text counts as empty: no ids, and an empty decoded text. Repeated rows are
encoded alike, each in its own row; null ids are kept. Very long texts and words are encoded
whole. An empty table gives an empty result. Other columns are not looked at; ``keep`` names
those that go along.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from wxengine.llm.chunks import (
    CHUNK_BYTES,
    bucket_count,
    bucket_of,
    packed_chunks,
    ragged_take,
    unpacked_chunk,
    with_chunks,
)
from wxengine.llm.memory import give_back

# Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Scripts whose character classes are the same in all versions of Unicode; a text with others
# is split by the library itself.
_SETTLED_RANGES = "\x00-՗‐-‧€ぁ-ゖァ-ヺ一-鿋가-힣"
_SETTLED = re.compile(f"[^{_SETTLED_RANGES}]")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranges(kind: str, chars: str) -> str:
    """The characters of a class of Unicode as ranges for a set of the standard library."""
    found = np.array([ord(c) for c in regex.findall(kind, chars)])
    cuts = np.flatnonzero(np.diff(found) != 1)
    firsts, lasts = found[[0, *(cuts + 1)]], found[[*cuts, -1]]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts, strict=True))


@lru_cache(maxsize=1)
def _settled_pattern() -> re.Pattern:
    """``PATTERN`` over settled characters, for the standard library, whose sets are faster.

    Letters come first, as what else may match begins with another character.
    """
    chars = "".join(re.findall(f"[{_SETTLED_RANGES}]", "".join(map(chr, range(0xD800)))))
    letter, number, space = (_ranges(kind, chars) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        f" [{letter}]+|[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+"
        f"| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


@lru_cache(maxsize=1)
def _piece_table(content: str) -> np.ndarray:
    """Bytes by id, read once a process; an id that is not in the vocabulary has none."""
    pieces = Codec(content).pieces
    table = np.full(max(pieces, default=-1) + 1, b"", dtype=object)
    for i, piece in pieces.items():
        table[i] = piece
    return table


class Codec:
    """Splits texts, and encodes and decodes single words, by a tokenizer file's content."""

    def __init__(self, content: str) -> None:
        self.content = content

    def __getstate__(self) -> dict:
        return {"content": self.content}

    @cached_property
    def _tokenizer(self) -> Tokenizer:
        # A task has one core; the library's threads would only wait for each other beside it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_str(self.content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @cached_property
    def _added(self) -> re.Pattern | None:
        words = [t["content"] for t in json.loads(self.content)["added_tokens"]]
        words.sort(key=len, reverse=True)
        return re.compile("|".join(map(re.escape, words))) if words else None

    @cached_property
    def _findall(self):
        return _settled_pattern().findall

    @cached_property
    def pieces(self) -> dict[int, bytes]:
        """Bytes of each id; an added token's are those of its own text."""
        parsed, symbols = json.loads(self.content), byte_symbols()
        out = {i: bytes(symbols[c] for c in piece) for piece, i in parsed["model"]["vocab"].items()}
        return out | {t["id"]: t["content"].encode() for t in parsed["added_tokens"]}

    def decode_ids(self, ids: np.ndarray) -> str:
        """The text of a document's ids, through the id-to-piece table."""
        return b"".join(_piece_table(self.content)[ids].tolist()).decode("utf-8", "replace")

    def _plain(self, text: str) -> list[str]:
        if _SETTLED.search(text):
            splitter = self._tokenizer.pre_tokenizer
            return [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]
        return self._findall(text)

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self._added is None or not self._added.search(text):
            return self._plain(text)
        out, done = [], 0
        for m in self._added.finditer(text):
            out += [*self._plain(text[done : m.start()]), m.group()]
            done = m.end()
        return out + self._plain(text[done:])

    def encode_words(self, words: list[str], at_once: int = 20_000) -> list[list[int]]:
        encode = self._tokenizer.encode_batch_fast
        return [
            e.ids
            for start in range(0, len(words), at_once)
            for e in encode(words[start : start + at_once], add_special_tokens=False)
        ]


def read_codec(path: str) -> Codec:
    with open(path, encoding="utf-8") as file:
        return Codec(file.read())


class Numbers(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def _distinct(codec: Codec, buckets: int):
    def words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """The distinct words of a chunk, sorted, in compressed lists by bucket."""
        found: set[str] = set()
        for rows in unpacked_chunk(table):
            for text in rows.column("_text"):
                found.update(codec.split(text.as_py()))
        lists: dict[int, list[str]] = {}
        for word in found:
            lists.setdefault(bucket_of(word, buckets), []).append(word)
        compress = zstandard.ZstdCompressor().compress
        blobs = [compress(json.dumps(sorted(own), ensure_ascii=False).encode()) for own in lists.values()]
        found.clear()
        give_back()
        return pa.table(
            {
                "_chunk": pa.array([key[0].as_py()] * len(lists), pa.int32()),
                "bucket": pa.array(lists.keys(), pa.int32()),
                "words": pa.array(blobs, pa.binary()),
            }
        )

    return words


# A bucket's words of one chunk, encoded, in the order of its list.
_ENCODED = "_chunk int, bucket int, sizes binary, ids binary"


def _encoder(codec: Codec):
    def encode(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor().decompress
        compress = zstandard.ZstdCompressor().compress
        lists = [json.loads(expand(blob.as_py())) for blob in table.column("words")]
        place: dict[str, int] = {}
        for own in lists:
            for word in own:
                place.setdefault(word, len(place))
        coded = codec.encode_words(list(place))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.uint32, int(sizes.sum()))
        out: dict[str, list] = {"sizes": [], "ids": []}
        for own in lists:
            index = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
            ids, counts = ragged_take(flat, sizes, index)
            out["sizes"].append(compress(counts.astype("<u4").tobytes()))
            out["ids"].append(compress(ids.astype("<u4").tobytes()))
        return pa.table(
            {
                "_chunk": table.column("_chunk"),
                "bucket": table.column("bucket"),
                "sizes": pa.array(out["sizes"], pa.binary()),
                "ids": pa.array(out["ids"], pa.binary()),
            }
        )

    return encode


def _assembler(codec: Codec, keep: tuple[str, ...], buckets: int):
    def assemble(table: pa.Table, answers: pa.Table) -> pa.Table:
        # Words are numbered as they come, then by bucket and order, as in the answers.
        seen = Numbers()
        kept, texts = [], []
        for rows in unpacked_chunk(table):
            kept.append(rows.select(keep))
            for text in rows.column("_text"):
                own = codec.split(text.as_py())
                texts.append(np.fromiter(map(seen.__getitem__, own), np.int32, len(own)))
        names = list(seen)
        lists: dict[int, list[int]] = {}
        for k, word in enumerate(names):
            lists.setdefault(bucket_of(word, buckets), []).append(k)
        expand = zstandard.ZstdDecompressor().decompress
        rank = np.empty(len(names), dtype=np.int64)
        sizes, ids, done = [], [], 0
        columns = (answers.column(c) for c in ("bucket", "sizes", "ids"))
        for bucket, own_sizes, own_ids in zip(*columns, strict=True):
            own = sorted(lists[bucket.as_py()], key=names.__getitem__)
            rank[own] = np.arange(done, done + len(own))
            done += len(own)
            sizes.append(np.frombuffer(expand(own_sizes.as_py()), "<u4").astype(np.int64))
            ids.append(np.frombuffer(expand(own_ids.as_py()), "<u4"))
        none = np.empty(0, np.int64)
        counts, flat = np.concatenate([none, *sizes]), np.concatenate([none.astype("<u4"), *ids])
        starts = np.cumsum(counts) - counts
        all_ids, all_texts = [], []
        for own in texts:
            taken, _ = ragged_take(flat, counts, rank[own], starts)
            all_ids.append(taken.tobytes())
            all_texts.append(codec.decode_ids(taken))
        columns = pa.concat_tables(kept).columns
        give_back()
        return pa.table(
            [*columns, pa.array(all_ids, pa.binary()), pa.array(all_texts, pa.string())],
            names=[*keep, "ids", "decoded"],
        )

    return assemble


def encode_decode(
    docs: DataFrame,
    codec: Codec,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document: id, columns to keep, ``ids`` (32-bit little-endian), ``decoded``."""
    names = (id_col, *keep)
    rows = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    chunked, chunks = with_chunks(rows, "_0", "_text", chunk_bytes)
    buckets = bucket_count(chunks)
    packed = packed_chunks(chunked)
    words = packed.groupBy("_chunk").applyInArrow(
        _distinct(codec, buckets), "_chunk int, bucket int, words binary"
    )
    encoded = words.groupBy("bucket").applyInArrow(_encoder(codec), _ENCODED)
    inner = tuple(f"_{i}" for i in range(len(names)))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in inner)
    out = (
        packed.groupBy("_chunk")
        .cogroup(encoded.groupBy("_chunk"))
        .applyInArrow(_assembler(codec, inner, buckets), f"{kinds}, ids binary, decoded string")
    )
    return out.select(
        *(F.col(i).alias(c) for i, c in zip(inner, names, strict=True)), "ids", "decoded"
    )


def unpacked(ids: Column) -> Column:
    """The packed ids as an array of integers."""

    @F.arrow_udf("array<int>")
    def numbers(packed: pa.Array) -> pa.Array:
        lists = (np.frombuffer(value.as_py() or b"", dtype="<i4") for value in packed)
        return pa.array(lists, type=pa.list_(pa.int32()))

    return numbers(ids)


def decode(rows: DataFrame, codec: Codec, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ``decoded``) of arrays of ids, through a join with the id-to-piece table.

    The table has one row for each id of the vocabulary, so it may be broadcast. Rows need
    distinct ids; an unknown token id decodes to nothing, as in the library.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame(list(codec.pieces.items()), "token int, piece binary")
    tokens = rows.select(F.col(id_col), F.posexplode_outer(ids_col).alias("_at", "token"))
    pieces = tokens.join(F.broadcast(table), "token", "left")
    hexes = F.array_sort(F.collect_list(F.struct("_at", F.hex("piece").alias("h"))))
    text = F.array_join(F.transform(hexes, lambda x: x["h"]), "")
    return pieces.groupBy(id_col).agg(F.decode(F.unhex(text), "UTF-8").alias("decoded"))
