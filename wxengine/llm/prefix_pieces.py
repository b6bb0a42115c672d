"""SentencePiece BPE by a table of the last token of each prefix.

A text is escaped (a mark for each blank, one more in front) and cut into units that no piece
of the vocabulary crosses: a run of marks with what follows it. Within a unit each prefix has
one token that its encoding can end with. Prefixes are gone through in order: an automaton
over all pieces names those that end there, and a piece is the one sought when it stays whole
beside the last token of the prefix before it, that is, when merging the two texts joined
gives back the pair. The ids are then recovered from the end of the unit, token by token, so
a unit takes time in proportion to its length. Characters without a piece match nothing,
separate what lies beside them, and become byte pieces.

Why pairs suffice: merges run in a fixed order (by score, then from the left), and the first
merge across a border depends only on the two tokens beside it, so a sequence of tokens is an
encoding exactly when each adjacent pair is.

Decoding looks the emitted ids up in the table of pieces and joins their bytes.

Each row is encoded where it lies, without a shuffle; a document is encoded whole. Units of
up to 64 characters and tests of pairs are remembered in each process, up to a fixed number.

Edge cases. A null text counts as empty: no ids, and an empty decoded text. Repeated rows are
encoded alike, each in its own row; null ids are kept. An empty table gives an empty result.
Other columns are not looked at; ``keep`` names those that go along. A mark (U+2581) in a text
is decoded as a blank, as in the library. Byte pieces that are not UTF-8 together, which no
encoding gives, decode to U+FFFD. Models that normalize or remove blanks, have pieces defined
by users or lack byte pieces are refused with a ValueError.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wxengine.llm.arrow_text import slices

MARK = "▁"
# Fixed values of the model's file format: field numbers, kinds of pieces, kind of model.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2
_REMEMBERED_UNITS, _LONGEST_REMEMBERED, _REMEMBERED_PAIRS = 150_000, 64, 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one message of a protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class Memo(dict):
    """Remembers answers for keys up to a length as they are asked."""

    def __init__(self, answer, longest: int) -> None:
        super().__init__()
        self._answer, self._longest = answer, longest

    def __missing__(self, key):
        value = self._answer(key)
        if len(key) <= self._longest:
            self[key] = value
        return value


class Pieces:
    """Encodes and decodes texts by the content of a SentencePiece BPE model file."""

    def __init__(self, model: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        kind, normalizer = 0, {}
        for field, value in _fields(model):
            if field == _PIECES:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece.get(2, b"\0" * 4))[0]
                self.pieces.append((piece[1].decode(), score, piece.get(3, _NORMAL)))
            elif field == _TRAINER:
                kind = dict(_fields(value)).get(3)
            elif field == _NORMALIZER:
                normalizer = dict(_fields(value))
        if kind != _BPE:
            raise ValueError("not a BPE model")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or not normalizer.get(3, 1):
            raise ValueError("the model's normalization of texts is not supported")
        kinds = {k for *_, k in self.pieces}
        if not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("pieces defined by users, or unused ones, are not supported")
        # A merge takes the highest score first.
        self._order = {p: -score for p, score, k in self.pieces if k == _NORMAL}
        if not all(c in self._order for piece in self._order for c in piece):
            raise ValueError("every character of a piece must be a piece")
        self._sizes = [len(p) if k == _NORMAL else 0 for p, _, k in self.pieces]
        self._byte_ids = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(self.pieces) if k == _BYTE}
        if len(self._byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        # Bytes by id, as decoding joins them.
        self.table = [self._decoded(*piece) for piece in self.pieces]
        crossed = any(re.search(f"[^{MARK}]{MARK}", p) for p in self._order)
        self._units = re.compile("(?s).+" if crossed else f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self._automaton = ahocorasick.Automaton()
        for i, (p, _, k) in enumerate(self.pieces):
            if k == _NORMAL:
                self._automaton.add_word(p, i)
        self._automaton.make_automaton()
        self._fits = Memo(self._is_pair, 2)
        self._known = Memo(self._encode_unit, _LONGEST_REMEMBERED)

    @staticmethod
    def _decoded(piece: str, score: float, kind: int) -> bytes:
        if kind == _BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == _CONTROL:
            return b""
        # Fixed value: how an unknown piece is shown.
        return " ⁇ ".encode() if kind == _UNKNOWN else piece.replace(MARK, " ").encode()

    def _merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: highest score first, then leftmost."""
        parts, order = list(text), self._order.get
        orders = [order(a + b, math.inf) for a, b in pairwise(parts)]
        while orders and (first := min(orders)) < math.inf:
            i = orders.index(first)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del orders[i]
            if i:
                orders[i - 1] = order(parts[i - 1] + parts[i], math.inf)
            if i < len(orders):
                orders[i] = order(parts[i] + parts[i + 1], math.inf)
        return parts

    def _is_pair(self, pair: tuple[int | None, int]) -> bool:
        """Whether a token stays whole after the one before it, or at the front."""
        own = [self.pieces[i][0] for i in pair if i is not None]
        return self._merged("".join(own)) == own

    def _encode_unit(self, unit: str) -> tuple[int, ...]:
        sizes, fits = self._sizes, self._fits
        # The last token of each prefix, by the place of its last character; none at the front,
        # which is at -1, and after a character without a piece.
        last: list[int | None] = [None] * (len(unit) + 1)
        for end, token in self._automaton.iter(unit):
            if last[end] is None and fits[last[end - sizes[token]], token]:
                last[end] = token
        ids, end = [], len(unit) - 1
        while end >= 0:
            token = last[end]
            if token is None:
                ids += [self._byte_ids[b] for b in reversed(unit[end].encode())]
                end -= 1
            else:
                ids.append(token)
                end -= sizes[token]
        ids.reverse()
        return tuple(ids)

    def units(self, text: str | None) -> list[str]:
        """The escaped text in parts that no piece crosses."""
        return self._units(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        if len(self._known) > _REMEMBERED_UNITS:
            self._known.clear()
        if len(self._fits) > _REMEMBERED_PAIRS:
            self._fits.clear()
        return list(chain.from_iterable(map(self._known.__getitem__, self.units(text))))

    def decode(self, ids: list[int]) -> str:
        joined = b"".join(map(self.table.__getitem__, ids))
        # The mark that encoding put in front is not a part of the text.
        front = next(compress(ids, map(self.table.__getitem__, ids)), None)
        if front is not None and self.pieces[front][0].startswith(MARK):
            joined = joined[1:]
        return joined.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def pieces_of(model: bytes) -> Pieces:
    """The pieces of a model, taken apart once a process."""
    return Pieces(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def id_lists(ids: list[np.ndarray]) -> pa.Array:
    """Arrays of 32-bit numbers as one column of lists."""
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(own) for own in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def encode_decode(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: id, columns to keep, ``ids`` (array of int), ``decoded``."""
    pieces_of(model)  # refuses a model before any task starts
    names = (id_col, *keep)
    inner = [f"_{i}" for i in range(len(names))]
    rows = docs.select(
        *(F.col(c).alias(i) for i, c in zip(inner, names, strict=True)), F.col(text_col).alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for part in slices(batch, "_text"):
                ids, texts = [], []
                for text in part.column("_text"):
                    own = pieces.encode(text.as_py())
                    ids.append(np.array(own, np.int32))
                    texts.append(pieces.decode(own))
                columns = [*part.columns[:-1], id_lists(ids), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*inner, "ids", "decoded"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in inner)
    out = rows.mapInArrow(run, f"{kinds}, ids array<int>, decoded string")
    return out.select(*(F.col(i).alias(c) for i, c in zip(inner, names, strict=True)), "ids", "decoded")
