"""Spelling variants: words one edit apart, found by variable-length grams.

The method follows "VGRAM" (Li, Wang and Yang, 2007):

- **Gram dictionary.** Grams of 2 to 4 letters of all distinct words are counted (a word's
  end counts as a letter). A gram that more words than a threshold have is extended by the
  next letter; others are not, which prunes all their extensions. The frequent grams are all
  that a task has to know. The threshold rises with the words so that at most ``GRAMS`` are
  frequent; they are broadcast, four bytes each.
- **Decomposition.** A word has one gram at each position: the shortest that is not frequent,
  or the longest allowed. Which one it is follows from the gram's own letters alone.
- **Affected grams.** One edit changes at most as many grams as cover one letter; the largest
  such number over a word's positions is its bound. Grams have at most one letter less than
  the shortest word, so each word has more grams than one edit can change. (The paper also
  drops grams within others; on words of five letters that would leave nothing unaffected.)
- **Merging lists.** Of a word's grams in a fixed order, rare ones first, as many are listed
  as its bound and one more. Two words one edit apart share a listed gram: fewer than the
  listed ones of each are affected, and the first gram that both keep is listed for both.
  Lists are kept by length too: one holds the words of a length and those one letter longer,
  which are compared if their letters allow, and each pair counts where its first common
  listed gram is.
- **Verifying.** Pairs are decided on their code points.

A list of any length is dealt into blocks which are compared in pairs, each pair of blocks in
a task of its own (``groups.py``); tasks return one row per word, never pairs. Nothing is
capped. Memory holds two blocks of a list.

Roots are found by doubling: each round follows a word's forms twice as far as the one
before, and is written to the shared folder. A form occurs at least twice as often as its
word, so chains are short and have no cycles.

Edge cases. A null text has no words. In a document without an id no letter is deleted. Texts
are read whole, words of any length too. Repeated rows are counted again. Ties between forms
go to the smallest in code-point order. An empty table, or one without frequent words, gives
an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F

from wxengine.llm.groups import comparison_tasks, run_tasks
from wxengine.session import shared_dir

LEAST_LETTERS = 5
LEAST_COUNT = 3
SHORTEST, LONGEST = 2, 4
# A gram is frequent in more than so many words; at most so many grams are frequent.
RARE, GRAMS = 64, 1_000_000
BLOCK = 2_000
_LETTERS = "[a-z\\u00C0-\\u00FF]+"
# Stands for a word's end; no word has it.
_END = 1
_PAIR_CELLS = 1 << 22


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters in A-Z lower case, each with its own chance of a lost letter."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        F.col(id_col).cast("string").alias("_id"),
        F.explode(F.regexp_extract_all(lower, F.lit(f"({_LETTERS})"))).alias("_run"),
    )
    hashed = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = F.pmod("_h", F.char_length("_run")).cast("int")
    shorter = F.concat(F.expr("substring(_run, 1, _at)"), F.expr("substring(_run, _at + 2)"))
    return (
        runs.withColumn("_h", hashed)
        .withColumn("_at", at)
        .select(F.when(F.col("_h") % 97 == 0, shorter).otherwise(F.col("_run")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of words of Latin letters end to end, each with its end mark, and sizes."""
    joined = "".join(word + chr(_END) for word in words).encode("latin-1")
    return np.frombuffer(joined, np.uint8), np.fromiter((len(w) + 1 for w in words), np.int64, len(words))


def _gram_at(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Grams of one size as numbers, one byte for each letter."""
    out = np.zeros(len(starts), np.uint32)
    for i in range(size):
        out = (out << np.uint32(8)) | codes[starts + i]
    return out


def _frequent_grams(
    words: DataFrame, longest: int, rare: int, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """The frequent grams, sorted, and their counts: those of more than a threshold.

    A threshold of the number of all grams by ``most`` leaves no more than ``most``.
    """

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            codes, sizes = _codes(frame["word"].tolist())
            left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
            for size in range(SHORTEST, longest + 1):
                own = _gram_at(codes, np.flatnonzero(left >= size), size)
                values, counts = np.unique(own, return_counts=True)
                yield pd.DataFrame({"gram": values.astype(np.int64), "n": counts})

    counted = words.select("word").mapInPandas(grams, "gram bigint, n bigint")
    letters = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    threshold = max(rare, -(-letters * (longest - SHORTEST + 1) // most))
    frequent = counted.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > threshold)
    rows = frequent.toArrow()
    grams = rows.column("gram").to_numpy().astype(np.uint32)
    order = np.argsort(grams)
    return grams[order], rows.column("n").to_numpy()[order]


def _counts_of(frequent: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> np.ndarray:
    """Counts of grams; 0 of those that are not frequent."""
    table, counts = frequent
    if not len(table):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, counts[at], 0)


def decompose(words: list[str], frequent: tuple[np.ndarray, np.ndarray], longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """For each word its grams by position, as numbers, and how many an edit can affect."""
    codes, sizes = _codes(words)
    bounds = np.cumsum(sizes)
    left = np.repeat(bounds, sizes) - np.arange(len(codes))
    starts = np.flatnonzero(left >= SHORTEST)
    grams = _gram_at(codes, starts, SHORTEST)
    length = np.full(len(starts), SHORTEST)
    open_ = np.arange(len(starts))
    for size in range(SHORTEST + 1, longest + 1):
        open_ = open_[(_counts_of(frequent, grams[open_]) > 0) & (left[starts[open_]] >= size)]
        grams[open_] = _gram_at(codes, starts[open_], size)
        length[open_] = size
    # How many grams cover each letter: one more from a gram's start, one less after its end.
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    covering = np.cumsum(change)
    first = bounds - sizes
    affected = np.maximum.reduceat(covering[:-1], first) if len(first) else np.empty(0, int)
    cuts = np.searchsorted(starts, first)
    for a, b, most in zip(cuts, [*cuts[1:], len(starts)], affected.tolist(), strict=True):
        yield grams[a:b], most


def _listed(frequent: tuple[np.ndarray, np.ndarray], longest: int):
    """Words with the grams they are listed under, rare ones first, packed as numbers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            lists = []
            for grams, most in decompose(frame["word"].tolist(), frequent, longest):
                # By count, and otherwise in an order that mixes the letters.
                mixed = grams * np.uint32(0x9E3779B1)
                order = np.lexsort((mixed, _counts_of(frequent, grams)))
                keys = list(dict.fromkeys(grams[order[: most + 1]].tolist()))
                lists.append(np.array(keys, ">u4").tobytes())
            yield pd.DataFrame({"word": frame["word"], "n": frame["n"], "keys": lists})

    return run


def _one_edit(codes: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the words of rows i and j, padded with zeros, are exactly one edit apart.

    Row j is as long as row i or one letter longer.
    """
    short, long = codes[i], codes[j]
    same = short == long
    width = codes.shape[1]
    prefix = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
    replaced = (~same).sum(axis=1) == 1
    # Without the letter of the longer word at which they part, the rest is the same.
    shifted = short[:, :-1] == long[:, 1:]
    shifted |= np.arange(width - 1)[None, :] < prefix[:, None]
    return np.where(sizes[i] == sizes[j], replaced, shifted.all(axis=1))


def _like(masks: np.ndarray, left: np.ndarray, right: np.ndarray, within: bool) -> Iterator[tuple]:
    """Pairs of rows of two sides whose letters are alike; each once where the sides are one."""
    rows = max(1, _PAIR_CELLS // max(len(right), 1))
    for start in range(0, len(left), rows):
        own = left[start : start + rows]
        # An edit takes away one letter and brings in another at most.
        close = np.bitwise_count(masks[own][:, None] ^ masks[right][None, :]) <= 2
        if within:
            close &= np.arange(start, start + len(own))[:, None] < np.arange(len(right))[None, :]
        i, j = np.nonzero(close)
        yield own[i], right[j]


def _near_pairs(
    words: list[str], side: np.ndarray, shorter: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (shorter or as long, other) of words one edit apart in a task.

    Words have ``shorter`` letters or one more; those that all have one more are compared in
    another list.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    short = sizes == shorter
    if not short.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    codes = np.zeros((len(words), shorter + 2), np.uint8)
    codes[np.arange(shorter + 2)[None, :] < sizes[:, None]] = flat
    masks = np.zeros(len(words), np.uint32)
    np.bitwise_or.at(masks, np.repeat(np.arange(len(words)), sizes), np.uint32(1) << (flat & 31))
    if side.any():
        one, two = side == 1, side == 2
        tries = [(short & one, short & two), (short & one, ~short & two), (short & two, ~short & one)]
    else:
        tries = [(short, short), (short, ~short)]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, _PAIR_CELLS // (shorter + 2))
    for left, right in tries:
        within = left is right
        for i, j in _like(masks, np.flatnonzero(left), np.flatnonzero(right), within):
            for at in range(0, len(i), step):
                x, y = i[at : at + step], j[at : at + step]
                near = _one_edit(codes, sizes, x, y)
                found.append((x[near], y[near]))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)])


def _compare(rows: pd.DataFrame, bounds: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
    """Near words of each word of a list: how many there are, and the most frequent."""
    out: list[tuple] = []
    words_of, counts = rows["word"].to_numpy(), rows["n"].to_numpy()
    keys_of, grams, side = rows["keys"].to_numpy(), rows["gram"].to_numpy(), rows["_side"].to_numpy()
    shorter = rows["shorter"].to_numpy()
    for a, b in bounds:
        words, n = words_of[a:b].tolist(), counts[a:b]
        i, j = _near_pairs(words, side[a:b], int(shorter[a]))
        if not len(i):
            continue
        # A pair counts in the list of its first common gram.
        keys = {k: np.frombuffer(keys_of[a + k], ">u4").tolist() for k in {*i.tolist(), *j.tolist()}}
        gram = int(grams[a])
        first = np.fromiter(
            (next(g for g in keys[x] if g in keys[y]) == gram for x, y in zip(i.tolist(), j.tolist())),
            bool,
            len(i),
        )
        own, other = np.concatenate([i[first], j[first]]), np.concatenate([j[first], i[first]])
        place = np.empty(len(words), np.int64)
        place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((place[other], -n[other], own))
        own, other = own[order], other[order]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        sizes = np.diff([*starts, len(own)])
        out += [
            (words[own[s]], int(k), words[other[s]], int(n[other[s]]))
            for s, k in zip(starts.tolist(), sizes.tolist(), strict=True)
        ]
    yield pd.DataFrame(out, columns=["word", "n_near", "near", "near_n"])


def near_words(
    words: DataFrame,
    least_letters: int = LEAST_LETTERS,
    rare: int = RARE,
    most_grams: int = GRAMS,
    block: int = BLOCK,
) -> DataFrame:
    """(word, n_near, near, near_n) of words (word, n) with others one edit apart.

    Words are of letters up to U+00FF and have at least ``least_letters`` (three or more).
    ``near`` is the most frequent, then the smallest.
    """
    spark = words.sparkSession
    longest = min(LONGEST, least_letters - 1)
    frequent = spark.sparkContext.broadcast(_frequent_grams(words, longest, rare, most_grams))

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _listed(frequent.value, longest)(frames)

    keyed = words.mapInPandas(listed, "word string, n bigint, keys binary")
    path = shared_dir(spark, "words-listed")
    keyed.write.parquet(path)
    keyed = spark.read.parquet(path)
    # A key's number, from its four bytes.
    key = F.conv(F.hex(F.expr("substring(keys, 4 * _i + 1, 4)")), 16, 10).cast("bigint")
    entries = keyed.withColumn(
        "_i", F.explode(F.sequence(F.lit(0), (F.octet_length("keys") / 4 - 1).cast("int")))
    ).select(key.alias("gram"), "word", "n", "keys")
    # A word is in the list of its length and, as one of the longer words, of the length before.
    letters = F.char_length("word")
    entries = entries.withColumn("shorter", F.explode(F.array(letters - 1, letters)))
    # Blocks of long words have fewer rows.
    weight = F.greatest(F.lit(1.0), letters / 64)
    tasks = comparison_tasks(entries, ["gram", "shorter"], "word", block, weight)
    found = run_tasks(tasks, _compare, "word string, n_near bigint, near string, near_n bigint")
    best: Column = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
        .select("word", "n_near", F.col("_best.near").alias("near"), (-F.col("_best.n")).alias("near_n"))
    )


def with_roots(words: DataFrame) -> DataFrame:
    """``words`` (word, form, ...) with ``root``: the last of a word's forms, or the word itself."""
    spark = words.sparkSession

    def stored(rows: DataFrame) -> tuple[DataFrame, int]:
        path, seen = shared_dir(spark, "roots"), Observation()
        rows.observe(seen, F.count_if("moved").alias("moved")).select("word", "root").write.parquet(path)
        return spark.read.schema("word string, root string").parquet(path), seen.get["moved"]

    forms = words.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    step, moved = stored(forms)
    while moved:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step, moved = stored(
            step.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            )
        )
    return words.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    **near,
) -> DataFrame:
    """Per word of ``least_letters`` and ``least_count`` or more: ``word``, ``form``, ``root``,
    ``n``, ``n_near``, ``form_n``."""
    spark = docs.sparkSession
    path = shared_dir(spark, "words")
    count_words(docs, id_col, text_col).where(
        (F.char_length("word") >= least_letters) & (F.col("n") >= least_count)
    ).write.parquet(path)
    words = spark.read.parquet(path)
    found = near_words(words, least_letters, **near)
    is_form = F.col("near_n") >= 2 * F.col("n")
    named = words.join(found, "word", "left").select(
        "word",
        F.when(is_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    named_path = shared_dir(spark, "words-named")
    named.write.parquet(named_path)
    return with_roots(spark.read.parquet(named_path)).select("word", "form", "root", "n", "n_near", "form_n")
