"""Alignment of two tokenizers' tokens, and how often each pair of ids is linked.

Both tokenizers cut the same bytes. Two dictionaries lead from the byte offset at which a token
ends to the token's index, one for each tokenizer; the offsets in both, sorted, cut the two
lists of ids into groups. Within a group, tokens whose byte ranges overlap are linked: all
with the one where either side has a single token, else by walking along both ends. Texts
are aligned in stretches between blanks that neither tokenizer has a token across, and equal
stretches once; a process remembers a bounded number of them.

Pairs of ids are counted over all documents without shuffling links. Documents are gone
through in chunks of bounded size: a chunk keeps each document's links as places in the
chunk's list of distinct pairs, and only that list, with its counts, goes on. Lists are added
up by pair, each pair finds the highest count of its second id, and the answers go back by
chunk and place. What is shuffled grows with the number of chunks times their distinct pairs,
hence in proportion to the input; sums are partial before the shuffle, so a pair that every
chunk has leaves a task once.

The aligned chunks are written to the shared folder, so that texts are encoded once and an
executor that is lost costs its tasks alone. A document is aligned whole.

Edge cases. A null or empty text, or one whose tokens of either side do not give back the
blank and the text (U+2581 counts as a blank to the second tokenizer), has no tokens: zeros
and an empty ``groups`` string. Repeated rows are aligned alike and each counts; null ids are
kept. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from wxengine.llm.arrow_text import slices
from wxengine.llm.bpe import Codec, Numbers
from wxengine.llm.chunks import ragged_take
from wxengine.llm.memory import give_back
from wxengine.llm.prefix_pieces import MARK, pieces_of
from wxengine.session import shared_dir

CHUNK_BYTES = 4 << 20
# Texts are gone through in parts of so many bytes; so many stretches, with names of so many
# characters, and parts of each side are remembered in a process. Stretches that were forgotten are
# aligned again, which is most of the work; parts come again within new stretches alone, so few are
# worth their memory.
_AT_ONCE, _REMEMBERED, _REMEMBERED_CHARS, _REMEMBERED_PARTS = 1 << 20, 400_000, 32 << 20, 60_000
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class Alignment:
    """Two lists of ids cut into groups: how many tokens of each side, and how many bytes, lie
    before a group's end; and the linked ids, with the byte offset at which each link ends."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    cuts: np.ndarray
    links: tuple[np.ndarray, np.ndarray]
    link_ends: np.ndarray


def common_ends(a_ends: list[int], b_ends: list[int], a_first: int, b_first: int) -> tuple[list, list, list]:
    """Ends of tokens of both sides, and how many tokens of each side end there or before.

    The sides' tokens are counted from ``a_first`` and ``b_first``.
    """
    a_index = dict(zip(a_ends, range(a_first + 1, a_first + len(a_ends) + 1), strict=True))
    b_index = dict(zip(b_ends, range(b_first + 1, b_first + len(b_ends) + 1), strict=True))
    common = sorted(a_index.keys() & b_index.keys())
    return common, list(map(a_index.__getitem__, common)), list(map(b_index.__getitem__, common))


def align(
    a_ids: np.ndarray,
    b_ids: np.ndarray,
    a_ends: np.ndarray,
    b_ends: np.ndarray,
    texts: list[tuple[int, int]],
) -> Alignment:
    """Cut two lists of ids where both have a token's end, and link overlapping tokens.

    Ends are cumulative byte offsets, strictly increasing. The lists may be of several texts
    end to end, ``texts`` being their numbers of tokens of either side.
    """
    common, a_cuts, b_cuts = [], [], []
    i = j = 0
    for n_a, n_b in texts:
        found = common_ends(a_ends[i : i + n_a].tolist(), b_ends[j : j + n_b].tolist(), i, j)
        common += found[0]
        a_cuts += found[1]
        b_cuts += found[2]
        i, j = i + n_a, j + n_b
    a_cuts, b_cuts = np.array(a_cuts, np.int64), np.array(b_cuts, np.int64)
    # Within a group ends of the two sides never meet, so walking along both, each of its ends
    # closes one overlap: between neighbouring ends of either side lies exactly one link.
    link_ends = np.concatenate([a_ends, np.delete(b_ends, b_cuts - 1)])
    link_ends.sort(kind="stable")
    links = a_ids[np.searchsorted(a_ends, link_ends)], b_ids[np.searchsorted(b_ends, link_ends)]
    return Alignment(a_ids, b_ids, a_cuts, b_cuts, np.array(common, np.int64), links, link_ends)


class Names:
    """Ids in decimal, each with the sign that follows it within a group and at a side's end."""

    def __init__(self, size: int, end: str) -> None:
        digits = list(map(str, range(size)))
        self._inner = np.array([d + "," for d in digits], object)
        self._last = np.array([d + end for d in digits], object)

    def of(self, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        names = self._inner[ids]
        names[cuts - 1] = self._last[ids[cuts - 1]]
        return names


def group_names(found: Alignment, a_names: Names, b_names: Names) -> np.ndarray:
    """The strings that joined give the groups as ``a1,a2|b1;a3|b2,b3;``, ids in decimal."""
    a_sizes, b_sizes = np.diff(found.a_cuts, prepend=0), np.diff(found.b_cuts, prepend=0)
    out = np.empty(len(found.a_ids) + len(found.b_ids), object)
    # Before a token lie those of its own side and the groups' other side before it.
    before = np.repeat(found.b_cuts - b_sizes, a_sizes)
    out[np.arange(len(found.a_ids)) + before] = a_names.of(found.a_ids, found.a_cuts)
    out[np.arange(len(found.b_ids)) + np.repeat(found.a_cuts, b_sizes)] = b_names.of(found.b_ids, found.b_cuts)
    return out


class _Side:
    """One tokenizer: texts fall into parts that no token crosses; each new part is encoded once.

    ``pieces`` are the bytes of each id, ``given`` the bytes that a part's tokens should have.
    """

    def __init__(
        self,
        split: Callable[[str], list[str]],
        encode: Callable[[list[str]], list[list[int]]],
        given: Callable[[str], bytes],
        pieces: list[bytes],
    ) -> None:
        self._split, self._encode, self._given, self._pieces = split, encode, given, pieces
        self.sizes = np.array([len(piece) for piece in pieces], np.int64)
        self._forget()

    def _forget(self) -> None:
        self._place = Numbers()
        self._flat, self._counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self._sound = np.empty(0, bool)

    def _learn(self, new: list[str]) -> None:
        for start in range(0, len(new), 10_000):
            parts = new[start : start + 10_000]
            coded = self._encode(parts)
            given = list(map(self._given, parts))
            ids, counts = list(chain.from_iterable(coded)), np.array(list(map(len, coded)), np.int64)
            flat = np.array(ids, np.int64)
            # Most often all parts are sound: each has as many bytes as its tokens, and all
            # bytes end to end are the same.
            ends = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(self.sizes[flat])])
            if np.array_equal(total[ends] - total[ends - counts], list(map(len, given))) and (
                b"".join(map(self._pieces.__getitem__, ids)) == b"".join(given)
            ):
                sound = np.ones(len(parts), bool)
            else:
                own = (b"".join(map(self._pieces.__getitem__, ids)) for ids in coded)
                sound = np.array([a == b for a, b in zip(own, given, strict=True)], bool)
            self._flat = np.concatenate([self._flat, flat])
            self._counts = np.concatenate([self._counts, counts])
            self._sound = np.concatenate([self._sound, sound])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All texts' ids end to end, how many each has, and whether its bytes come back."""
        if len(self._place) > _REMEMBERED_PARTS:
            self._forget()
        done = len(self._place)
        lists = [self._split(text) for text in texts]
        sizes = np.array(list(map(len, lists)), np.int64)
        index = np.fromiter(
            map(self._place.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum())
        )
        self._learn(list(islice(self._place, done, None)))
        ids, counts = ragged_take(self._flat, self._counts, index)
        ends = np.cumsum(sizes)
        total = np.concatenate([[0], np.cumsum(counts)])
        bad = np.concatenate([[0], np.cumsum(~self._sound[index])])
        return ids, total[ends] - total[ends - sizes], bad[ends] == bad[ends - sizes]


class Encoder:
    """Encodes texts with both tokenizers and aligns the tokens."""

    def __init__(self, a_content: str, b_model: bytes) -> None:
        # Without added tokens their strings are plain text.
        codec = Codec(json.dumps(json.loads(a_content) | {"added_tokens": []}))
        pieces = pieces_of(b_model)
        library = SentencePieceProcessor(model_proto=b_model)

        lone = [library.piece_to_id(MARK)]

        def unmarked(units: list[str]) -> list[list[int]]:
            # The library puts the first mark in front itself, but not before an empty text: the
            # blank that a text ends with is a unit of one mark.
            coded = library.encode([u[1:].replace(MARK, " ") for u in units], num_threads=1)
            return [lone if u == MARK else ids for u, ids in zip(units, coded, strict=True)]

        a_pieces = [codec.pieces.get(i, b"") for i in range(max(codec.pieces) + 1)]
        self._a = _Side(codec.split, codec.encode_words, str.encode, a_pieces)
        self._b = _Side(
            lambda text: pieces.units(text[1:]), unmarked, lambda u: u.replace(MARK, " ").encode(), pieces.table
        )
        self.a_names, self.b_names = Names(len(a_pieces), "|"), Names(len(pieces.table), ";")

    def align(self, texts: list[str]) -> tuple[Alignment, np.ndarray, np.ndarray, np.ndarray]:
        """The alignment of texts that begin with a blank, end to end; and the byte offset at
        which each token of either side ends; and whether each text's bytes come back.

        Where those of a text do not, nothing is aligned.
        """
        (a_ids, n_a, a_sound), (b_ids, n_b, b_sound) = self._a.ids(texts), self._b.ids(texts)
        sound = a_sound & b_sound
        if not sound.all():
            a_ids, b_ids, n_a, n_b = a_ids[:0], b_ids[:0], n_a * 0, n_b * 0
        a_ends, b_ends = np.cumsum(self._a.sizes[a_ids]), np.cumsum(self._b.sizes[b_ids])
        counts = list(zip(n_a.tolist(), n_b.tolist(), strict=True))
        return align(a_ids, b_ids, a_ends, b_ends, counts), a_ends, b_ends, sound


# Neither tokenizer has a token across a single blank before a character that is none: the
# blank begins one of both. Characters beyond these could be blanks to one of them.
_BORDERS = re.compile("(?<! )(?= [!-~\u00A1-\u024F])")
_JOINED = 200
# Aligning stretches takes far more memory than what is kept of them, so so many are done at once.
_LEARNED_AT_ONCE = 20_000


def stretches(text: str | None) -> list[str]:
    """A blank and the text, cut where both tokenizers do; nothing of a null or empty text."""
    return [part for part in _BORDERS.split(" " + text) if part] if text else []


def _runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of these starts and sizes, end to end, and their sizes."""
    first = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return flat[first + np.arange(int(sizes.sum()))], sizes


class Aligner:
    """Aligns texts by their stretches, each distinct one once.

    Pairs of ids are numbered as they come.
    """

    def __init__(self, a_content: str, b_model: bytes) -> None:
        self._encoder = Encoder(a_content, b_model)
        self._forget()

    def _forget(self) -> None:
        self._place, self.pairs = Numbers(), Numbers()
        # Of each stretch: whether it is sound, tokens of both sides, groups, links.
        self._counts = np.empty((5, 0), np.int32)
        self._links, self._names, self._chars = np.empty(0, np.int32), [], 0

    def begin(self) -> None:
        """Forget what was seen if that is much; numbers of pairs hold until the next call."""
        if len(self._place) > _REMEMBERED or self._chars > _REMEMBERED_CHARS:
            self._forget()

    def _learn(self, new: list[str]) -> None:
        """Align new stretches, many of them joined to one text."""
        # A mark is a blank to the second tokenizer, and the bytes differ. A text's first stretch
        # may begin without a border, and its last end with a blank, which borders nothing.
        alone, joined = [], []
        for s in new:
            if MARK not in s and len(s) > 1:
                (joined if s[-1] != " " and _BORDERS.match(s) else alone).append(s)
        texts = [[s] for s in alone] + [joined[i : i + _JOINED] for i in range(0, len(joined), _JOINED)]
        found, a_ends, b_ends, sound = self._encoder.align(["".join(own) for own in texts])
        if not sound.all():
            texts = [[s] for own, good in zip(texts, sound.tolist(), strict=True) for s in own if good or len(own) > 1]
            *_, sound = self._encoder.align(["".join(own) for own in texts])
            texts = [own for own, good in zip(texts, sound.tolist(), strict=True) if good]
            found, a_ends, b_ends, _ = self._encoder.align(["".join(own) for own in texts])
        kept = [s for own in texts for s in own]
        ends = np.cumsum([len(s.encode()) for s in kept], dtype=np.int64)
        n_a, n_b = np.searchsorted(a_ends, ends, side="right"), np.searchsorted(b_ends, ends, side="right")
        groups = np.searchsorted(found.cuts, ends, side="right")
        links = np.searchsorted(found.link_ends, ends, side="right")
        counts = [np.diff(x, prepend=0) for x in (n_a, n_b, groups, links)]
        names = group_names(found, self._encoder.a_names, self._encoder.b_names).tolist()
        stops = (n_a + n_b).tolist()
        texts_of = ["".join(names[a:b]).encode() for a, b in pairwise([0, *stops])]
        keys = (found.links[0] << 32) + found.links[1]
        own = np.fromiter(map(self.pairs.__getitem__, keys.tolist()), np.int32, len(keys))
        # Stretches are known in the order in which they came; unsound ones have no tokens.
        first = len(self._names)
        place = np.fromiter(map(self._place.__getitem__, kept), np.int64, len(kept)) - first
        all_counts, starts = np.zeros((5, len(new)), np.int64), np.zeros(len(new), np.int64)
        all_counts[:, place] = [np.ones(len(kept), np.int64), *counts]
        starts[place] = links - counts[3]
        own, _ = _runs(own, starts, all_counts[4])
        all_names = [b""] * len(new)
        for k, text in zip(place.tolist(), texts_of, strict=True):
            all_names[k] = text
        self._names += all_names
        self._chars += sum(map(len, texts_of))
        self._counts = np.concatenate([self._counts, all_counts.astype(np.int32)], axis=1)
        self._links = np.concatenate([self._links, own])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per text: tokens of both sides, groups, links as one array; digests; and the numbers
        of all linked pairs end to end with how many each text has."""
        done = len(self._place)
        lists = [stretches(text) for text in texts]
        sizes = np.array(list(map(len, lists)), np.int64)
        index = np.fromiter(
            map(self._place.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum())
        )
        new = list(islice(self._place, done, None))
        for start in range(0, len(new), _LEARNED_AT_ONCE):
            self._learn(new[start : start + _LEARNED_AT_ONCE])
        ends = np.cumsum(sizes)
        added = np.cumsum(self._counts[:, index], axis=1, dtype=np.int64)
        added = np.concatenate([np.zeros((5, 1), np.int64), added], axis=1)
        per_text = added[:, ends] - added[:, ends - sizes]
        # A text counts with all of its stretches or not at all.
        whole = (per_text[0] == sizes) & (sizes > 0)
        per_text *= whole
        digests = []
        for end, size, good in zip(ends.tolist(), sizes.tolist(), whole.tolist(), strict=True):
            own = b"".join(map(self._names.__getitem__, index[end - size : end].tolist()))[:-1] if good else b""
            digests.append(hashlib.sha256(own).hexdigest() if good else "")
        links, _ = ragged_take(self._links, self._counts[4], index[np.repeat(whole, sizes)])
        return per_text[1:], digests, links, per_text[4]


@lru_cache(maxsize=1)
def _remembered(a_content: str, b_model: bytes) -> Aligner:
    return Aligner(a_content, b_model)


# A chunk: its documents with their links as places in its list of pairs, a compressed Arrow
# stream, and the list, pairs as first id * 2^32 + second id, with the counts in the chunk.
_CHUNK = "_chunk bigint, _docs binary, _pairs array<bigint>, _times array<bigint>"


def _aligner(a_content: str, b_model: bytes, chunk_bytes: int):
    def packed(number: int, aligner: Aligner, docs: list[tuple]) -> pa.RecordBatch:
        times = sum(np.bincount(links, minlength=len(aligner.pairs)) for *_, links, _ in docs)
        own = np.flatnonzero(times)
        place = np.zeros(len(times), np.int32)
        place[own] = np.arange(len(own))
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        names, stream = ["_id", *_COUNTS, "groups_sha256", "_places"], None
        for ids, numbers, digests, links, counts in docs:
            arrays = [ids, *(pa.array(n) for n in numbers), pa.array(digests, pa.string())]
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place[links]))
            batch = pa.RecordBatch.from_arrays([*arrays, places], names=names)
            stream = stream or pa.ipc.new_stream(sink, batch.schema, options=options)
            stream.write_batch(batch)
        stream.close()
        keys = np.fromiter(aligner.pairs, np.int64, len(aligner.pairs))[own]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.array([keys], pa.list_(pa.int64())),
                pa.array([times[own]], pa.list_(pa.int64())),
            ],
            names=["_chunk", "_docs", "_pairs", "_times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _remembered(a_content, b_model)
        # Chunks are numbered within their partition.
        number = TaskContext.get().partitionId() << 32
        docs, size = [], 0
        for batch in batches:
            for part in slices(batch, "_text", _AT_ONCE):
                if not docs:
                    aligner.begin()
                found = aligner.align(part.column("_text").to_pylist())
                docs.append((part.column("_id"), *found))
                size += part.column("_text").nbytes
                if size >= chunk_bytes:
                    yield packed(number, aligner, docs)
                    number, docs, size = number + 1, [], 0
                    give_back()
        if docs:
            yield packed(number, aligner, docs)
            docs = []
        give_back()

    return run


def _scored(table: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk, with what the counts of their pairs add up to."""
    order = np.argsort(answers.column("_place").to_numpy())
    counts = answers.column("_count").to_numpy()[order]
    best = answers.column("_best").to_numpy()[order]
    out = []
    for value in table.column("_docs"):
        for batch in pa.ipc.open_stream(value.as_buffer()):
            places = batch.column("_places")
            ends = np.cumsum(places.value_lengths().to_numpy())
            flat = places.flatten().to_numpy()
            sums = [
                np.diff(np.concatenate([[0], np.cumsum(values[flat], dtype=np.int64)])[[0, *ends]])
                for values in (best.astype(np.int64), counts)
            ]
            columns = [*batch.columns[:-1], *(pa.array(s, pa.int64()) for s in sums)]
            out.append(pa.Table.from_arrays(columns, names=[*batch.schema.names[:-1], "n_best", "count_sum"]))
    return pa.concat_tables(out)


def align_documents(
    docs: DataFrame,
    a_content: str,
    b_model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Documents, and pairs of ids.

    Per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best``
    (links whose pair is the most frequent of its second id, ties included), ``count_sum``.
    Per pair: ``a``, ``b``, ``n`` (links in all documents), ``best``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    path = shared_dir(spark, "aligned")
    rows.mapInArrow(_aligner(a_content, b_model, chunk_bytes), _CHUNK).write.parquet(path)
    chunks = spark.read.schema(_CHUNK).parquet(path)

    lists = chunks.select("_chunk", F.posexplode(F.arrays_zip("_pairs", "_times")).alias("_place", "_own"))
    lists = lists.select("_chunk", "_place", F.col("_own._pairs").alias("_pair"), F.col("_own._times").alias("_times"))
    counted = lists.groupBy("_pair").agg(F.sum("_times").alias("n"))
    counted = counted.select(
        "_pair",
        F.shiftright("_pair", 32).cast("int").alias("a"),
        F.col("_pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        "n",
    )
    pair_path = shared_dir(spark, "pairs")
    counted.write.parquet(pair_path)
    counted = spark.read.parquet(pair_path)
    highest = counted.groupBy("b").agg(F.max("n").alias("_highest"))
    pairs = counted.join(highest, "b").select("_pair", "a", "b", "n", (F.col("n") == F.col("_highest")).alias("best"))

    answers = lists.join(pairs, "_pair").select(
        F.col("_chunk").alias("_of"), "_place", F.col("n").alias("_count"), F.col("best").cast("int").alias("_best")
    )
    kind = rows.schema["_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in _COUNTS)
    found = (
        chunks.select("_chunk", "_docs")
        .groupBy("_chunk")
        .cogroup(answers.groupBy("_of"))
        .applyInArrow(_scored, f"_id {kind}, {numbers}, groups_sha256 string, n_best bigint, count_sum bigint")
    )
    return found.withColumnRenamed("_id", id_col), pairs.drop("_pair")
