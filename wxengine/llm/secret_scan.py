"""Secrets in free text: fixed patterns, and windows of high character entropy.

Edge cases. A null or empty text has no span and stays as it is under ``redact``. A text is
always scanned whole. Each row is scanned on its own, so repeated rows repeat their result,
an empty table gives an empty one, and other columns are never looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

Span = tuple[str, int, int]

# The base patterns, in the order in which kinds sort at equal starts, with the
# group that must reach a length and that length. Runs of one class of characters state their
# length in the pattern, which finds the same matches: what is left of a short run is shorter.
BASE_PATTERNS = (
    (
        "assign",
        re.compile(
            r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
            r"""([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]{16,}"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
BASE_KINDS = tuple(kind for kind, *_ in BASE_PATTERNS)

SPANS_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


@dataclass(frozen=True)
class EntropyClass:
    """Candidate strings over one alphabet, and the entropy that makes a window suspicious."""

    kind: str
    candidate: str
    window: int
    bits: float


# A window of random characters stays above the limit, one of words or numbers below it.
ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])", 20, 2.9),
    EntropyClass("entropy_alnum", r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}(?![A-Za-z0-9])", 20, 3.7),
    EntropyClass("entropy_base64", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}", 24, 4.0),
)

# Candidates that are known not to be secrets.
ALLOWED = (
    r"[0-9+/_=-]+",  # numbers, dates, rulers
    r"[A-Za-z+/_=-]+",  # words, paths, identifiers without a digit
    r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}",  # UUIDs
    r".*(?:EXAMPLE|example|XXXX|xxxx|0123456789|abcdefgh|ABCDEFGH|changeme|placeholder).*",
    r"(?:[A-Za-z]{2,}[/_-]+)+[A-Za-z0-9]{0,12}",  # words joined to a path or a name
)


def dense_runs(text: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Stretches covered by windows with at least ``bits`` of Shannon entropy per character.

    The sum of c * log2(c) over the window's counts changes in two terms when the window
    moves on by one character; the entropy is log2(window) less that sum over the window.
    """
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    limit = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        counts[char] = c + 1
        total += term[c + 1] - term[c]
        if i >= window:
            gone = text[i - window]
            c = counts[gone]
            counts[gone] = c - 1
            total += term[c - 1] - term[c]
        start = i - window + 1
        if start >= 0 and total <= limit:
            if begin >= 0 and start > end:
                yield begin, end
                begin = start
            elif begin < 0:
                begin = start
            end = i + 1
    if begin >= 0:
        yield begin, end


class Scanner:
    """Finds the spans of one text: base patterns, then what entropy adds outside them."""

    def __init__(
        self,
        classes: tuple[EntropyClass, ...] = ENTROPY_CLASSES,
        allowed: tuple[str, ...] = ALLOWED,
    ) -> None:
        self._classes = [(c, re.compile(c.candidate)) for c in classes]
        self._allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
        order = BASE_KINDS + tuple(c.kind for c in classes)
        self._rank = {kind: i for i, kind in enumerate(order)}

    def __call__(self, text: str | None) -> list[Span]:
        if not text:
            return []
        found: list[Span] = []
        for kind, pattern, group, least in BASE_PATTERNS:
            found += [
                (kind, *m.span())
                for m in pattern.finditer(text)
                if m.end(group) - m.start(group) >= least
            ]
        known = [(start, end) for _, start, end in found]
        for cls, pattern in self._classes:
            for m in pattern.finditer(text):
                word, at = m.group(), m.start()
                if self._allowed and self._allowed.fullmatch(word):
                    continue
                for start, end in dense_runs(word, cls.window, cls.bits):
                    start, end = start + at, end + at
                    if not any(a <= start and end <= b for a, b in known):
                        found.append((cls.kind, start, end))
                        known.append((start, end))
        return sorted(found, key=lambda s: (s[1], self._rank[s[0]], s[2]))


def spans(text: Column, scanner: Scanner | None = None) -> Column:
    """All spans of a text as an array of (kind, start, end), in code points."""
    scan = scanner or Scanner()

    @F.arrow_udf(SPANS_TYPE)
    def found(texts: pa.Array) -> pa.Array:
        rows = (scan(value.as_py()) for value in texts)
        return pa.array(
            [[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows],
            type=_ARROW_SPANS,
        )

    return found(text)


def redacted(text: Column, mark: str = "[SECRET]", scanner: Scanner | None = None) -> Column:
    """The text with every span, overlapping ones taken together, replaced by ``mark``."""
    scan = scanner or Scanner()

    def clean(value: str | None) -> str | None:
        parts, done = [], 0
        for _, start, end in scan(value):
            if start >= done:
                parts += [value[done:start], mark]
            done = max(done, end)
        return "".join([*parts, value[done:]]) if parts else value

    @F.arrow_udf("string")
    def replaced(texts: pa.Array) -> pa.Array:
        return pa.array((clean(value.as_py()) for value in texts), type=pa.string())

    return replaced(text)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and the array ``spans``."""
    return docs.select(F.col(id_col), spans(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced in the text, and its length updated."""
    out = docs.withColumn(text_col, redacted(F.col(text_col)))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.char_length(F.col(text_col)).cast(kind))
    return out
