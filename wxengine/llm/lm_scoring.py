"""Log probability of texts under prediction by partial matching, learned from the corpus.

The model is a trie of byte contexts up to order 5, with the counts of all training texts.
A symbol is looked up in the longest context that was seen. Where it does not follow there,
the escape estimate of method D (half a count for each distinct symbol) is paid, and the next
shorter context is asked without the symbols of the longer one, down to all bytes alike.
Texts are lower-cased in A-Z; each is preceded by five marks and followed by one, the byte
0xFF, which UTF-8 never uses, so that text lengths have probabilities too.

A unigram model over words is scored beside it: words are runs without space and \\x09-\\x0D,
each text ends in one more token, and a token's probability is (c + 1) / (N + V + 1).

Both models grow with the corpus and are neither collected nor broadcast. Texts are dealt
into chunks; each chunk hands its distinct words and byte 6-grams to the tables once and
gets the counts and log probabilities of just those back (see ``chunks``). Log probabilities
of 6-grams are worked out in buckets of contexts that share their last three bytes, which
hold all that orders 3 to 5 need; the counts of order 2 come with them from a join, and those
of orders 0 and 1, at most 65,536, are broadcast.

Edge cases. A null text counts as empty: its end is its only token. Without training texts
every count is 0 and every byte has probability 1/256. Rows whose training flag is null do
not train. Repeated rows count, and are scored, each for itself. An empty table gives an
empty result. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from wxengine.llm.arrow_text import LOWER, Pieces, mix, pieces
from wxengine.llm.chunks import (
    CHUNK_BYTES,
    bucket_count,
    packed_chunks,
    unpacked_chunk,
    with_chunks,
)
from wxengine.session import shared_dir

ORDER = 5
MARK = 0xFF
# A word has no space, so this stands for the end of a text among the words.
END = b" "
_GRAM = ORDER + 1
# Bytes of text whose 6-grams are held at a time.
_PIECE = 1 << 20


def grams(piece: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """6-grams of all positions of all texts as integers, and where each text's begin.

    A text of n bytes has n + 1 of them: one that ends at each byte, and one at its mark.
    """
    sizes = piece.ends - piece.starts
    firsts = np.concatenate([[0], np.cumsum(sizes + _GRAM)])
    padded = np.full(firsts[-1], MARK, dtype=np.uint8)
    inside = np.arange(len(piece.data)) + np.repeat(
        firsts[:-1] + ORDER - piece.starts, sizes
    )
    padded[inside] = LOWER[piece.data]
    keys = np.zeros(len(padded) - ORDER, dtype=np.int64)
    for i in range(_GRAM):
        keys = (keys << 8) | padded[i : len(keys) + i]
    whole = np.ones(len(keys) + ORDER, dtype=bool)
    for i in range(ORDER):
        whole[firsts[1:] - 1 - i] = False  # these would run on into the next text
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    return keys[whole[: len(keys)]], begins


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ascending array begins."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with their counts added up."""
    keys, counts = (np.concatenate(parts) for parts in zip(*found, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    firsts = _firsts(keys)
    return keys[firsts], np.add.reduceat(counts[order], firsts)


def _counted(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 6-grams in ascending order, and how many of each are of training texts.

    Sorting whole numbers is much faster than hashing them, so the flag goes along as a bit.
    """
    tagged = (keys << 1) | training
    tagged.sort()
    ordered = tagged >> 1
    firsts = _firsts(ordered)
    return ordered[firsts], np.add.reduceat(tagged & 1, firsts)


def _coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """6-grams that are distinct within each run of 65,536 keys, and each key's place in them.

    A 6-gram has 48 bits, so its number within the run fits beside it and sorts along.
    """
    distinct, place, done = [], np.empty(len(keys), dtype=np.int32), 0
    numbers = np.arange(1 << 16, dtype=np.uint64)
    for start in range(0, len(keys), 1 << 16):
        own = keys[start : start + (1 << 16)].view(np.uint64) << np.uint64(16)
        own |= numbers[: len(own)]
        own.sort()
        ordered = (own >> np.uint64(16)).view(np.int64)
        firsts = _firsts(ordered)
        codes = np.arange(done, done + len(firsts), dtype=np.int32)
        at = (own & np.uint64(0xFFFF)).view(np.int64)
        place[start : start + len(own)][at] = np.repeat(codes, np.diff(firsts, append=len(own)))
        distinct.append(ordered[firsts])
        done += len(firsts)
    return np.concatenate(distinct), place


def _blob(values: np.ndarray | bytes) -> bytes:
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes()
    return zstandard.ZstdCompressor().compress(raw)


def _expanded(blob: pa.Scalar) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob.as_py())


def _integers(blob: pa.Scalar, deltas: bool = False) -> np.ndarray:
    values = np.frombuffer(_expanded(blob), dtype=np.int64)
    return np.cumsum(values) if deltas else values


def _gram_buckets(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 6-gram, by the last three bytes of its context."""
    context = (grams >> 8) & ((1 << 24) - 1)
    return (mix(context.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


# A chunk's terms of one bucket: words between tabs, or ascending 6-grams as differences;
# and their counts in the chunk's training texts.
_TERMS = "_chunk int, bucket int, words binary, grams binary, counts binary"


def _terms(buckets: int):
    def terms(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Distinct words and 6-grams of a chunk, with their counts in its training texts."""
        words: Counter[bytes] = Counter({END: 0})
        others: set[bytes] = set()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for rows in unpacked_chunk(table):
            training = rows.column("_training").to_numpy()
            for first, piece in pieces(rows.column("_text"), _PIECE):
                own = training[first : first + len(piece.starts)]
                lowered = LOWER[piece.data].tobytes()
                for trains, a, b in zip(own, piece.starts, piece.ends, strict=True):
                    (words if trains else others).update(lowered[a:b].split())
                words[END] += int(own.sum())
                keys, _ = grams(piece)
                found.append(_counted(keys, np.repeat(own, piece.ends - piece.starts + 1)))
                if len(found) == 8:
                    found = [_summed(found)]
        lists: dict[int, list[bytes]] = {}
        for word in words.keys() | others:
            lists.setdefault(zlib.crc32(word) % buckets, []).append(word)
        rows_: list[tuple] = []
        for bucket, own in lists.items():
            own.sort()
            counts = np.fromiter(map(words.__getitem__, own), np.int64, len(own))
            rows_.append((bucket, _blob(b"\t".join(own)), None, _blob(counts)))
        distinct, counts = _summed(found)
        bucket_of = _gram_buckets(distinct, buckets)
        order = np.argsort(bucket_of, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket_of[order], prepend=-1, append=-1))
        for a, b in pairwise(cuts.tolist()):
            own = order[a:b]
            blob = _blob(np.diff(distinct[own], prepend=0))
            rows_.append((int(bucket_of[own[0]]), None, blob, _blob(counts[own])))
        columns = list(zip(*rows_, strict=True))
        chunk = pa.array([key[0].as_py()] * len(rows_), pa.int32())
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.table([chunk, *arrays], names=["_chunk", "bucket", "words", "grams", "counts"])

    return terms


class Level:
    """Contexts of one order with the symbols seen or asked for after them.

    A row is a context and a symbol, as one number ``key`` with a byte for each; rows are in
    ascending order. ``entry`` is the log probability of the symbol for a look-up that starts
    here, ``after`` that for one that has escaped from here.
    """

    def __init__(
        self, order: int, keys: np.ndarray, counts: np.ndarray, below: Level | None = None
    ) -> None:
        self.keys = keys
        self.counts = counts
        _, first, self.context = np.unique(keys >> 8, return_index=True, return_inverse=True)
        seen = counts > 0
        self.total = np.bincount(self.context, counts)
        self.distinct = np.bincount(self.context, seen)
        if below is None:
            self.after = np.full(len(keys), -np.log(max(256 - self.distinct[0], 1)))
            start = np.full(len(keys), -np.log(256))
        else:
            down = np.searchsorted(below.keys, keys & ((1 << (8 * order)) - 1))
            parent = below.context[down[first]]
            # One order down, the symbols of this context are left out.
            lower = below.counts[down]
            total = below.total[parent] - np.bincount(self.context, np.where(seen, lower, 0))
            distinct = below.distinct[parent] - self.distinct
            room = total[self.context]
            escape = _log(distinct / 2, total)[self.context]
            self.after = np.where(
                lower > 0, _log(lower - 0.5, room), escape + below.after[down]
            )
            start = below.entry[down]
        room = self.total[self.context]
        escape = _log(self.distinct / 2, self.total)[self.context]
        known = np.where(seen, _log(counts - 0.5, room), escape + self.after)
        self.entry = np.where(room > 0, known, start)


def _log(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """log(x / of), and 0 (a factor of 1) where there is nothing to choose from."""
    sound = (x > 0) & (of > 0)
    return np.log(np.where(sound, x, 1) / np.where(sound, of, 1))


def log_probabilities(
    gram: np.ndarray, n: np.ndarray, triple: np.ndarray, triple_n: np.ndarray, pairs: np.ndarray
) -> np.ndarray:
    """Natural log probability of each 6-gram's last byte after the five before it.

    ``gram`` are all 6-grams of some contexts of order 3, with their counts ``n``; ``triple``
    and ``triple_n`` are those of order 2 with the same last two bytes, ``pairs`` all counts
    of order 1.
    """
    level = Level(0, np.arange(1 << 8), pairs.reshape(256, 256).sum(axis=0))
    level = Level(1, np.arange(1 << 16), pairs, level)
    ascending = np.argsort(triple)
    level = Level(2, triple[ascending], triple_n[ascending], level)
    for order in range(3, ORDER + 1):
        keys, place = np.unique(gram & ((1 << (8 * order + 8)) - 1), return_inverse=True)
        level = Level(order, keys, np.bincount(place, n), level)
    return level.entry[np.searchsorted(level.keys, gram)]


def _word_counts(table: pa.Table) -> pa.Table:
    """Counts over all chunks for each chunk's words of a bucket, and the bucket's totals."""
    lists = [_expanded(blob).split(b"\t") for blob in table.column("words")]
    totals: dict[bytes, int] = {}
    for own, blob in zip(lists, table.column("counts"), strict=True):
        for word, n in zip(own, _integers(blob).tolist(), strict=True):
            totals[word] = totals.get(word, 0) + n
    answers = [
        _blob(np.fromiter(map(totals.__getitem__, own), np.int64, len(own))) for own in lists
    ]
    rest = [0] * (len(lists) - 1)
    return pa.table(
        {
            "_chunk": table.column("_chunk"),
            "bucket": table.column("bucket"),
            "counts": pa.array(answers, pa.binary()),
            "tokens": pa.array([sum(totals.values()), *rest], pa.int64()),
            "distinct": pa.array([sum(n > 0 for n in totals.values()), *rest], pa.int64()),
        }
    )


def _grams_of(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The chunks' 6-grams of a bucket; the distinct ones, and their counts over all chunks."""
    own = [_integers(blob, deltas=True) for blob in table.column("grams")]
    distinct, n = _summed(
        [(g, _integers(blob)) for g, blob in zip(own, table.column("counts"), strict=True)]
    )
    return own, distinct, n


def _triples(table: pa.Table) -> pa.Table:
    """Counts of the last three bytes of a bucket's 6-grams, and which contexts ask for them."""
    _, distinct, n = _grams_of(table)
    keys, place = np.unique(distinct & ((1 << 24) - 1), return_inverse=True)
    bucket = np.full(len(keys), table.column("bucket")[0].as_py(), dtype=np.int32)
    return pa.table(
        {"bucket": bucket, "triple": keys, "n": np.bincount(place, n).astype(np.int64)}
    )


def _gram_logs(pairs: Broadcast):
    def logs(table: pa.Table, lower: pa.Table) -> pa.Table:
        """Log probabilities for each chunk's 6-grams of a bucket."""
        own, distinct, n = _grams_of(table)
        logp = log_probabilities(
            distinct,
            n.astype(np.float64),
            lower.column("triple").to_numpy(),
            lower.column("n").to_numpy().astype(np.float64),
            pairs.value,
        )
        answers = [_blob(logp[np.searchsorted(distinct, keys)]) for keys in own]
        return pa.table(
            {
                "_chunk": table.column("_chunk"),
                "bucket": table.column("bucket"),
                "counts": pa.nulls(len(own), pa.binary()),
                "logs": pa.array(answers, pa.binary()),
            }
        )

    return logs


def _scores(buckets: int):
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        count_of: dict[int, np.ndarray] = {}
        log_of: dict[int, np.ndarray] = {}
        columns = (answers.column(c) for c in ("bucket", "counts", "logs"))
        for bucket, counts, logs in zip(*columns, strict=True):
            if counts.is_valid:
                count_of[bucket.as_py()] = _integers(counts)
            else:
                log_of[bucket.as_py()] = np.frombuffer(_expanded(logs), dtype=np.float64)
        batches = list(unpacked_chunk(table))
        # The chunk's terms again, in the order of the lists that it handed in. Words are
        # numbered as they come, so that each text is split, and each word looked up, once.
        place: defaultdict[bytes, int] = defaultdict()
        place.default_factory = place.__len__
        end = place[END]
        parts: list[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]] = []
        for rows in batches:
            for _, piece in pieces(rows.column("_text"), _PIECE):
                lowered = LOWER[piece.data].tobytes()
                tokens = []
                for a, b in zip(piece.starts, piece.ends, strict=True):
                    own = lowered[a:b].split()
                    tokens.append(np.fromiter(map(place.__getitem__, own), np.int32, len(own)))
                keys, begins = grams(piece)
                parts.append((tokens, *_coded(keys), begins))
        lists: dict[int, list[bytes]] = {}
        for word in place:
            lists.setdefault(zlib.crc32(word) % buckets, []).append(word)
        counts = np.empty(len(place), dtype=np.int64)
        for bucket, own in lists.items():
            own.sort()
            counts[np.fromiter(map(place.__getitem__, own), np.int64, len(own))] = count_of.pop(bucket)
        known = np.sort(np.concatenate([distinct for _, distinct, _, _ in parts]))
        known = known[_firsts(known)]
        logp = np.empty(len(known))
        bucket_of = _gram_buckets(known, buckets)
        order = np.argsort(bucket_of, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket_of[order], prepend=-1, append=-1))
        for a, b in pairwise(cuts.tolist()):
            logp[order[a:b]] = log_of.pop(int(bucket_of[order[a]]))
        out: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "log_counts", "score")}
        log_counts = np.log10(counts + 1.0)
        for tokens, distinct, codes, begins in parts:
            for own in tokens:
                own = np.append(own, np.int32(end))
                out["n_tokens"].append(len(own))
                out["n_known"].append(int(np.count_nonzero(counts[own])))
                out["log_counts"].append(float(log_counts[own].sum()))
            values = logp[np.searchsorted(known, distinct)]
            out["score"] += (np.add.reduceat(values[codes], begins) / np.log(10)).tolist()
        kept = pa.concat_tables([rows.select(["_id", "_training"]) for rows in batches])
        return pa.table([*kept.columns, *out.values()], names=["_id", "_training", *out])

    return score


def score_texts(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document: id, ``training``, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"),
        F.coalesce(training, F.lit(False)).alias("_training"),
    )
    kind = rows.schema["_id"].dataType.simpleString()
    chunked, chunks = with_chunks(rows, "_id", "_text", chunk_bytes)
    buckets = bucket_count(chunks)
    packed = packed_chunks(chunked)
    path = shared_dir(spark, "lm-terms")
    packed.groupBy("_chunk").applyInArrow(_terms(buckets), _TERMS).write.parquet(path)
    terms = spark.read.schema(_TERMS).parquet(path)

    word_path = shared_dir(spark, "lm-words")
    words = terms.where("words is not null").groupBy("bucket").applyInArrow(
        _word_counts, "_chunk int, bucket int, counts binary, tokens bigint, distinct bigint"
    )
    words.write.parquet(word_path)
    words = spark.read.schema(words.schema).parquet(word_path)
    tokens, distinct = (x or 0 for x in words.agg(F.sum("tokens"), F.sum("distinct")).first())

    gram_terms = terms.where("grams is not null").select("_chunk", "bucket", "grams", "counts")
    triple_path = shared_dir(spark, "lm-triples")
    gram_terms.groupBy("bucket").applyInArrow(
        _triples, "bucket int, triple bigint, n bigint"
    ).write.parquet(triple_path)
    asked = spark.read.schema("bucket int, triple bigint, n bigint").parquet(triple_path)
    triples = asked.groupBy("triple").agg(F.sum("n").alias("n"))
    pairs = np.zeros(1 << 16)
    last_two = F.col("triple").bitwiseAND(0xFFFF).cast("int").alias("pair")
    for row in triples.groupBy(last_two).agg(F.sum("n").alias("n")).collect():
        pairs[row["pair"]] = row["n"]
    two = F.shiftright("triple", 8).alias("two")
    lower = (
        asked.select("bucket", two)
        .distinct()
        .join(triples.select(two, "triple", "n"), "two")
        .select("bucket", "triple", "n")
    )
    logs = (
        gram_terms.groupBy("bucket")
        .cogroup(lower.groupBy("bucket"))
        .applyInArrow(
            _gram_logs(spark.sparkContext.broadcast(pairs)),
            "_chunk int, bucket int, counts binary, logs binary",
        )
    )
    answers = words.select(
        "_chunk", "bucket", "counts", F.lit(None).cast("binary").alias("logs")
    ).unionByName(logs)
    scored = (
        packed.groupBy("_chunk")
        .cogroup(answers.groupBy("_chunk"))
        .applyInArrow(
            _scores(buckets),
            f"_id {kind}, _training boolean, n_tokens bigint, n_known bigint,"
            " log_counts double, score double",
        )
    )
    room = float(np.log10(float(tokens + distinct + 1)))
    return scored.select(
        F.col("_id").alias(id_col),
        F.col("_training").alias("training"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        "score",
    )
