"""Language of a text from its words, backing off to shorter and shorter character n-grams.

A word that the model knows is scored by its frequency in each language. An unseen word is
cut into its character n-grams (with a mark at both ends) of the longest length at which the
model knows at least one; their mean log frequency, with a penalty for each step back, stands
in for the word.

The classifier is fitted on a bounded sample: at most about ``ROWS_PER_LANGUAGE`` labelled
rows of each language, taken by a hash of the id, or all of them where there are fewer. It
keeps at most ``WORDS_PER_LANGUAGE`` words and ``GRAMS_PER_LANGUAGE`` n-grams of a length for
each of at most ``LANGUAGES`` languages, so its size has a fixed bound; it is broadcast.
Every whole text is scored.

Edge cases. A null text, or one without a letter, is ``und`` with score 0, and so is every
text when nothing can be learned. Rows without a label teach nothing. Ties between languages
go to the one that sorts first. Repeated rows are scored alike; repeated labelled rows count
as often as they occur. Only id, text and label columns are looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from wxengine.llm.arrow_text import map_batches, slices
from wxengine.llm.memory import give_back

UNKNOWN = "und"
ROWS_PER_LANGUAGE = 4_000
WORDS_PER_LANGUAGE = 40_000
GRAMS_PER_LANGUAGE = 20_000
LANGUAGES = 256
LONGEST = 4
_BACKOFF = float(np.log(0.4))
_MEMO = 100_000
_COUNTED_BYTES = 2 << 20
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> Counter[str]:
    """Runs of letters of a text in lower case, with how often each occurs."""
    return Counter(_LETTERS.findall(text.lower())) if text else Counter()


def has_letter(words: Counter[str]) -> bool:
    # The pattern also takes number signs such as fractions for letters.
    return any(c.isalpha() for word in words for c in word)


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single characters without marks."""
    if size == 1:
        return list(word)
    marked = f"^{word}$"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


class Table:
    """Log frequencies of terms, a row for each term and a column for each language."""

    def __init__(self, rows: dict[str, int], logs: np.ndarray) -> None:
        self._rows, self._logs = rows, logs

    def get(self, term: str) -> np.ndarray | None:
        row = self._rows.get(term)
        return None if row is None else self._logs[row]


@dataclass
class Model:
    """Log frequencies by language: of words, and of n-grams by length."""

    languages: list[str]
    words: Table
    grams: dict[int, Table]
    memo: dict[str, np.ndarray] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "memo": {}}

    def word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is None:
            known = self.memo.get(word)
        if known is None:
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            known = self.memo[word] = self._unseen(word)
        return known

    def _unseen(self, word: str) -> np.ndarray:
        for size in range(LONGEST, 0, -1):
            table = self.grams[size]
            found = [row for g in grams(word, size) if (row := table.get(g)) is not None]
            if found:
                return np.mean(found, axis=0) + _BACKOFF * (LONGEST + 1 - size)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letter_words(text)
        if not self.languages or not has_letter(words):
            return UNKNOWN, 0.0
        scores = np.array([self.word(w) for w in words])
        counts = np.fromiter(words.values(), dtype=np.float64, count=len(words))
        total = counts @ scores
        # Words are not independent; the square root keeps long texts from being certain.
        odds = np.exp((total - total.max()) / np.sqrt(counts.sum()))
        best = int(np.argmax(total))
        return self.languages[best], float(odds[best] / odds.sum())


def _sample(rows: DataFrame, per_language: int) -> DataFrame:
    """Labelled rows, each language thinned by a hash of the id to about ``per_language``."""
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    kept = {r["lang"]: r["n"] for r in sizes.limit(LANGUAGES).collect()}
    if not kept:
        return rows.limit(0)
    share = F.create_map(
        *(
            x
            for lang, n in kept.items()
            for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))
        )
    )
    place = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 20)) / F.lit(1 << 20)
    return rows.where(place < F.try_element_at(share, F.col("lang")))


def _counted(batch: pa.RecordBatch) -> Iterator[dict]:
    """(size, term, language, count), size 0 being a whole word, over parts of a batch."""
    for part in slices(batch, "text", _COUNTED_BYTES):
        yield _counts(part)


def _counts(batch: pa.RecordBatch) -> dict:
    counts: dict[tuple[int, str], Counter[str]] = {}
    langs = batch.column("lang").to_pylist()
    for text, lang in zip(batch.column("text").to_pylist(), langs, strict=True):
        words = letter_words(text)
        counts.setdefault((0, lang), Counter()).update(words)
    for _, lang in list(counts):
        words = counts[(0, lang)]
        for size in range(1, LONGEST + 1):
            table: Counter[str] = Counter()
            for word, n in words.items():
                for gram in grams(word, size):
                    table[gram] += n
            counts[(size, lang)] = table
    flat = [(s, t, lang, n) for (s, lang), table in counts.items() for t, n in table.items()]
    columns = list(zip(*flat, strict=True)) or [(), (), (), ()]
    return dict(zip(("size", "term", "lang", "n"), map(list, columns), strict=True))


def fit(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    words_per_language: int = WORDS_PER_LANGUAGE,
    grams_per_language: int = GRAMS_PER_LANGUAGE,
) -> Model:
    """Learn from the rows where ``training`` holds and text and language are there."""
    rows = docs.where(training).select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    rows = _sample(rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()), rows_per_language)
    terms = (
        map_batches(rows.select("text", "lang"), "size int, term string, lang string, n bigint", _counted)
        .groupBy("size", "term", "lang")
        .agg(F.sum("n").alias("n"))
    )
    # A word seen once says less than its n-grams.
    terms = terms.where((F.col("size") > 0) | (F.col("n") > 1))
    rank = F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "term"))
    most = F.when(F.col("size") == 0, words_per_language).otherwise(grams_per_language)
    kept = terms.withColumn("rank", rank).where(F.col("rank") <= most)
    totals: Counter[tuple[int, str]] = Counter()
    found: dict[int, dict[str, dict[str, int]]] = {size: {} for size in range(LONGEST + 1)}
    for size, term, lang, n in kept.select("size", "term", "lang", "n").toLocalIterator():
        found[size].setdefault(term, {})[lang] = n
        totals[size, lang] += n
    languages = sorted({lang for _, lang in totals})

    def logs(size: int) -> Table:
        table = found.pop(size)
        room = np.array([totals[size, lang] for lang in languages]) + 0.5 * len(table) + 1
        counts = np.array([[n.get(lang, 0) for lang in languages] for n in table.values()])
        frequency = (counts.reshape(len(table), len(languages)) + 0.5) / room
        return Table({t: i for i, t in enumerate(table)}, np.log(frequency).astype(np.float32))

    return Model(languages, logs(0), {size: logs(size) for size in range(1, LONGEST + 1)})


def predicted(text: Column, model: Broadcast) -> Column:
    """Struct of ``lang_pred`` and ``score`` for a text."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        scored = (model.value.predict(value.as_py()) for value in texts)
        found = pa.array([{"lang_pred": lang, "score": s} for lang, s in scored], type=kind)
        give_back()
        return found

    return predict(text)


def identify(docs: DataFrame, training: Column, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with a struct column ``_language``, by a model fitted on their training rows."""
    model = docs.sparkSession.sparkContext.broadcast(
        fit(docs, training, text_col=text_col, **options)
    )
    return docs.withColumn("_language", predicted(F.col(text_col), model))


def reject_unidentified(docs: DataFrame, training: Column, least: float = 0.3, **options) -> DataFrame:
    """``docs`` without texts in no language, or whose best language is under ``least``."""
    found = identify(docs, training, **options)
    kept = (F.col("_language.lang_pred") != UNKNOWN) & (F.col("_language.score") >= least)
    return found.where(kept).select(*docs.columns)
