"""Toxicity from confirmed examples and unlabelled text: non-negative PU learning.

A text is the set of its words and of the first 4 to 7 letters of each. Linear classifiers
are trained in numpy by gradient descent on the class-prior-corrected risk
    prior * R_pos(+) + max(0, R_unl(-) - prior * R_pos(-))
with the logistic loss: unlabelled text counts as negative, less the positives hidden in it.
Where the corrected negative part falls below zero the step goes back up instead.

The classifiers are fitted on a bounded sample: at most about ``POSITIVES`` toxic and
``UNLABELLED`` other texts, taken by a hash of the id, dealt out by the same hash to
``FOLDS`` tasks that train one classifier each; the score is the mean of their outputs. The
prior, the share of toxic among the texts not confirmed as such, follows from the share of
toxic among all labelled training rows. A classifier has at most
``FEATURES`` features, so the broadcast model has a fixed bound. Every whole text is scored.

Edge cases. A null or empty text has no feature and gets the score of the intercepts alone.
Without toxic or without other examples nothing can be learned: every score is the prior (0
without toxic ones). Null labels or ids teach nothing; an id labelled twice counts as toxic if
any of its labels is. Repeated documents are scored alike. Only named columns are looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

POSITIVES = 4_000
UNLABELLED = 12_000
FOLDS = 4
FEATURES = 4_000
LEAST_TEXTS = 3
LEAST_LIFT = 2.0
LEAST_Z = 4.0
PREFIXES = range(3, 9)
LEVELS = (1, 2, 3)
STEPS = 400
RATE = 0.05
DECAY = 1e-5
_MEMO = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter[str]:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def stems(word: str) -> list[str]:
    """A word and its beginnings; what a text is counted by."""
    return [word, *(f"{word[:n]}-" for n in PREFIXES if n < len(word))]


def counted(text: str | None) -> Counter[str]:
    """How often each stem is used in a text."""
    counts: Counter[str] = Counter()
    for word, n in words_of(text).items():
        for stem in stems(word):
            counts[stem] += n
    return counts


class Vocabulary:
    """Numbers for the features of a set of texts: each stem at each level."""

    def __init__(self) -> None:
        self.stems: dict[str, int] = {}

    def features(self, text: str | None) -> np.ndarray:
        """Numbers of all stems of a text, at each level that their uses reach."""
        counts = counted(text)
        rows = [self.stems.setdefault(stem, len(self.stems)) for stem in counts]
        base = np.array(rows, dtype=np.int64) * len(LEVELS)
        uses = np.fromiter(counts.values(), np.int64, len(counts))
        parts = [base[uses >= level] + i for i, level in enumerate(LEVELS)]
        return np.concatenate(parts).astype(np.int32)

    def names(self, features: np.ndarray) -> list[str]:
        stems = list(self.stems)
        return [f"{stems[f // len(LEVELS)]} {LEVELS[f % len(LEVELS)]}" for f in features.tolist()]


@dataclass
class Side:
    """Some texts as (text, feature) pairs, in two arrays."""

    texts: np.ndarray
    features: np.ndarray
    n: int

    def margins(self, weights: np.ndarray, intercept: float) -> np.ndarray:
        return np.bincount(self.texts, weights[self.features], self.n) + intercept

    def gradient(self, slopes: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.features, slopes[self.texts], size)


def _side(group: list[np.ndarray], rows: np.ndarray) -> Side:
    """Texts by their features' rows; features without a row (-1) are left out."""
    found = [own[own >= 0] for own in (rows[features] for features in group)]
    sizes = [len(own) for own in found]
    return Side(np.repeat(np.arange(len(group)), sizes), np.concatenate(found), len(group))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(positives: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Features that are clearly more frequent in toxic than in other texts, best first."""
    size = 1 + max(int(own.max(initial=0)) for group in (positives, others) for own in group)
    seen, elsewhere = (
        np.bincount(np.concatenate(group), minlength=size) for group in (positives, others)
    )
    n, m = len(positives), len(others)
    rate, other, both = seen / n, elsewhere / m, (seen + elsewhere) / (n + m)
    spread = np.sqrt(both * (1 - both) * (1 / n + 1 / m))
    z = np.divide(rate - other, spread, out=np.zeros(size), where=spread > 0)
    fit = (seen >= LEAST_TEXTS) & (rate > LEAST_LIFT * other) & (z > LEAST_Z)
    best = np.flatnonzero(fit)
    return best[np.argsort(-z[best], kind="stable")][:FEATURES]


def train(
    positives: list[np.ndarray], others: list[np.ndarray], prior: float
) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, their weights, and the intercept that minimise the non-negative PU risk."""
    chosen = telling(positives, others)
    size = 1 + max(int(own.max(initial=0)) for group in (positives, others) for own in group)
    rows = np.full(size, -1, dtype=np.int64)
    rows[chosen] = np.arange(len(chosen))
    pos, oth = _side(positives, rows), _side(others, rows)
    # The last weight is the intercept's; Adam's running means of slopes and their squares.
    weights, mean, square = np.zeros((3, len(chosen) + 1))
    weights[-1] = np.log(prior / (1 - prior))
    decay = np.full(len(chosen) + 1, DECAY)
    decay[-1] = 0
    for step in range(1, STEPS + 1):
        m_pos, m_oth = (side.margins(weights[:-1], weights[-1]) for side in (pos, oth))
        p_pos, p_oth = _sigmoid(m_pos), _sigmoid(m_oth)
        negative = np.logaddexp(0, m_oth).mean() - prior * np.logaddexp(0, m_pos).mean()
        if negative >= 0:
            s_pos, s_oth = np.full(pos.n, -prior / pos.n), p_oth / oth.n
        else:
            s_pos, s_oth = prior * p_pos / pos.n, -p_oth / oth.n
        slope = decay * weights
        slope[:-1] += pos.gradient(s_pos, len(chosen)) + oth.gradient(s_oth, len(chosen))
        slope[-1] += s_pos.sum() + s_oth.sum()
        mean += (1 - 0.9) * (slope - mean)
        square += (1 - 0.99) * (slope**2 - square)
        rate = RATE * (1 - step / (STEPS + 1))
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return chosen, weights[:-1], float(weights[-1])


@dataclass
class Model:
    """The classifiers of all folds: a row of weights for each feature, and intercepts."""

    rows: dict[str, int]
    weights: np.ndarray
    intercepts: np.ndarray
    prior: float
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.stems = {feature.rpartition(" ")[0] for feature in self.rows}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def _known(self, word: str) -> tuple[str, ...]:
        known = self.known.get(word)
        if known is None:
            if len(self.known) >= _MEMO:
                self.known.clear()
            known = self.known[word] = tuple(s for s in stems(word) if s in self.stems)
        return known

    def score(self, text: str | None) -> float:
        if not len(self.intercepts):
            return self.prior
        counts: Counter[str] = Counter()
        for word, n in words_of(text).items():
            for stem in self._known(word):
                counts[stem] += n
        names = (f"{stem} {k}" for stem, n in counts.items() for k in LEVELS if n >= k)
        rows = sorted(self.rows[f] for f in names if f in self.rows)
        return float(_sigmoid(self.weights[rows].sum(axis=0) + self.intercepts).mean())


def sample(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str,
    text_col: str,
    label_col: str,
    positives: int,
    unlabelled: int,
) -> tuple[DataFrame, float]:
    """Training texts with ``toxic`` and ``fold``, and the prior.

    Shares of both kinds are taken by a hash of the id, so the sample needs no sort; its ids,
    bounded by ``positives`` and ``unlabelled``, are broadcast to where the texts are.
    """
    labelled = (
        labels.where(training & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_toxic"))
    )
    n, toxic = labelled.agg(F.count("*"), F.sum("_toxic")).first()
    share = float(toxic or 0) / n if n else 0.0
    texts = docs.where(training & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    ids = texts.select("_id").join(labelled, "_id", "left")
    toxic_text = F.coalesce(F.col("_toxic") == 1, F.lit(False))
    sizes = ids.agg(F.count_if(toxic_text), F.count_if(~toxic_text)).first()
    found, others = max(1, sizes[0]), max(1, sizes[1])
    # Texts known not to be toxic stay among the unlabelled and thin out those hidden there.
    prior = share * max(0, others - (n - (toxic or 0))) / others
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("_id")), F.lit(1 << 20)) / F.lit(1 << 20)
    most = F.when(toxic_text, min(1.0, positives / found)).otherwise(min(1.0, unlabelled / others))
    picked = ids.where(draw < most).select("_id", toxic_text.alias("toxic")).distinct()
    rows = texts.where(F.col("_text").isNotNull()).join(F.broadcast(picked), "_id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("_id")), F.lit(FOLDS))
    return (
        rows.select("_text", "toxic", fold.alias("fold")),
        min(max(prior, 1e-4), 0.5) if toxic else 0.0,
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model:
    """Train one classifier for each fold of the sample, each in a task of its own."""
    rows, prior = sample(
        docs, labels, training, id_col, text_col, label_col, positives, unlabelled
    )

    def train_fold(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        vocabulary = Vocabulary()
        groups = [
            [vocabulary.features(text) for text in part["_text"][part["toxic"] == own]]
            for own in (True, False)
        ]
        out: dict[str, list] = {"fold": [], "feature": [], "weight": []}
        if all(groups):
            chosen, weights, intercept = train(*groups, prior)
            out = {
                "fold": [key[0]] * (len(weights) + 1),
                "feature": [None, *vocabulary.names(chosen)],
                "weight": [intercept, *weights.tolist()],
            }
        kinds = {"fold": "int64", "feature": "object", "weight": "float64"}
        return pd.DataFrame({name: pd.Series(out[name], dtype=kinds[name]) for name in out})

    learned = (
        rows.repartition(FOLDS, "fold")
        .groupBy("fold")
        .applyInPandas(train_fold, "fold long, feature string, weight double")
        .collect()
    )
    folds = {fold: i for i, fold in enumerate(sorted({r["fold"] for r in learned}))}
    names = sorted({r["feature"] for r in learned if r["feature"] is not None})
    at = {name: i for i, name in enumerate(names)}
    weights, intercepts = np.zeros((len(names), len(folds))), np.zeros(len(folds))
    for row in learned:
        if row["feature"] is None:
            intercepts[folds[row["fold"]]] = row["weight"]
        else:
            weights[at[row["feature"]], folds[row["fold"]]] = row["weight"]
    return Model(at, weights, intercepts, prior)


def score(text: Column, model: Broadcast) -> Column:
    """Probability that a text is toxic, from 0 to 1."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([model.value.score(value.as_py()) for value in texts], type=pa.float64())

    return scored(text)


def with_toxicity(
    docs: DataFrame, labels: DataFrame, training: Column, text_col: str = "text", **options
) -> DataFrame:
    """``docs`` with a column ``_toxicity``, by classifiers fitted on their training rows."""
    model = docs.sparkSession.sparkContext.broadcast(
        fit(docs, labels, training, text_col=text_col, **options)
    )
    return docs.withColumn("_toxicity", score(F.col(text_col), model))
