import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wxengine.llm import lm_scoring
from wxengine.llm.queries import op2_lm_scoring

SF_DIR = "/root/testdata/sf0.001"
ORDER = lm_scoring.ORDER


def lowered(text):
    return (text or "").encode().lower()


class Trie:
    """Prediction by partial matching with escape D and exclusion, symbol by symbol."""

    def __init__(self, texts):
        self.after = [defaultdict(Counter) for _ in range(ORDER + 1)]
        for text in texts:
            s = b"\xff" * ORDER + lowered(text) + b"\xff"
            for i in range(ORDER, len(s)):
                for k in range(ORDER + 1):
                    self.after[k][s[i - k : i]][s[i]] += 1

    def log10(self, text):
        s = b"\xff" * ORDER + lowered(text) + b"\xff"
        return sum(self.symbol(s[i - ORDER : i], s[i]) for i in range(ORDER, len(s))) / math.log(10)

    def symbol(self, context, symbol):
        total, excluded = 0.0, set()
        for k in range(ORDER, -1, -1):
            seen = self.after[k].get(context[ORDER - k :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            room = sum(left.values())
            if symbol in left:
                return total + math.log((left[symbol] - 0.5) / room)
            if left:
                total += math.log(len(left) * 0.5 / room)
            excluded |= set(seen)
        return total - math.log(256 - len(excluded))


def expected(rows, trains):
    trie = Trie([t for i, t in rows if trains(i)])
    counts = Counter()
    for i, text in rows:
        if trains(i):
            counts.update(lowered(text).split())
            counts[b" "] += 1
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = [*lowered(text).split(), b" "]
        score = math.fsum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        out.append((i, len(own), sum(counts[w] > 0 for w in own), total, score, trie.log10(text)))
    return out


def check(got, want):
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0], r[1], r[5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_query_against_brute_force(spark, documents):
    trains = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = op2_lm_scoring(spark, SF_DIR).collect()
    assert all(r["held_out"] == (not trains(r["doc_id"])) for r in got)
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    short = {i for i, t in rows if len(t) < 3000}
    got = [tuple(r[c] for c in columns) for r in got if r["doc_id"] in short]
    check(got, [w for w in expected(rows, trains) if w[0] in short])


def test_edges(make_docs):
    rows = [(1, "the cat sat on the mat"), (2, None), (2, None), (3, ""), (4, "ÄÖ the\x0bcat " * 50), (None, "the dog")]
    got = lm_scoring.score_texts(make_docs(rows), F.col("doc_id") < 4).drop("training").collect()
    check([tuple(r) for r in got], expected(rows, lambda i: i is not None and i < 4))
    none = lm_scoring.score_texts(make_docs(rows[:1]), F.lit(False)).first()
    assert none["score"] == pytest.approx(-(len(rows[0][1]) + 1) * math.log10(256))
    assert lm_scoring.score_texts(make_docs([]), F.lit(True)).count() == 0


def test_probabilities_of_all_symbols_sum_to_one(make_docs):
    base = "abcabcabdabx" * 3
    rows = [(1, base), *((k, "abcab" + chr(k)) for k in range(10, 64))]
    got = {
        r["doc_id"]: r["score"]
        for r in lm_scoring.score_texts(make_docs(rows), F.col("doc_id") == 1).collect()
    }
    trie = Trie([base])
    assert sum(10 ** (trie.symbol(b"abcab", s) / math.log(10)) for s in range(256)) == pytest.approx(1)
    assert got[10] == pytest.approx(trie.log10("abcab\n"))


def test_a_chunk_looks_each_word_up_once(monkeypatch):
    """However many pieces a chunk's texts are held in, a word finds its bucket once."""
    monkeypatch.setattr(lm_scoring, "_PIECE", 50)
    texts = [f"some words come again {i % 3}" for i in range(30)]
    rows = pa.table({"_id": pa.array(range(30)), "_text": pa.array([t.encode() for t in texts])})
    rows = rows.append_column("_training", pa.array([i % 2 == 0 for i in range(30)]))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as stream:
        stream.write_table(rows)
    chunk = pa.table({"_chunk": pa.array([0], pa.int32()), "rows": pa.array([sink.getvalue().to_pybytes()])})
    terms = lm_scoring._terms(1)((pa.scalar(0),), chunk)
    words, others = (terms.filter(pa.compute.is_valid(terms.column(c))) for c in ("words", "grams"))
    assert sorted(lm_scoring._grams_of(others)[1].tolist()) == sorted(
        {int.from_bytes((b"\xff" * 5 + t.encode() + b"\xff")[i : i + 6]) for t in texts for i in range(len(t) + 1)}
    )
    counted = lm_scoring._word_counts(words).select(["_chunk", "bucket", "counts"])
    logs = lm_scoring._grams_of(others)[2].astype(float)
    answers = pa.concat_tables(
        [
            counted.append_column("logs", pa.nulls(1, pa.binary())),
            counted.select(["_chunk", "bucket"])
            .append_column("counts", pa.nulls(1, pa.binary()))
            .append_column("logs", pa.array([lm_scoring._blob(logs)], pa.binary())),
        ]
    )
    asked = []
    monkeypatch.setattr(lm_scoring, "zlib", type("Z", (), {"crc32": lambda w: asked.append(w) or 0}))
    scored = lm_scoring._scores(1)(chunk, answers)
    assert scored.column("n_tokens").to_pylist() == [6] * 30
    assert scored.column("n_known").to_pylist() == [6] * 30
    distinct = {b" ", *(w.encode() for t in texts for w in t.split())}
    assert set(asked) == distinct and len(asked) <= len(distinct) + 1


def test_grams_are_counted_and_numbered_as_by_brute_force():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 48, 5_000)[rng.integers(0, 5_000, 150_000)]
    keys[:3] = (1 << 48) - 1
    training = rng.integers(0, 2, len(keys)).astype(bool)
    distinct, place = lm_scoring._coded(keys)
    assert np.array_equal(distinct[place], keys) and len(distinct) <= 3 * 5_001
    want, at = np.unique(keys, return_inverse=True)
    for got, n in (lm_scoring._counted(keys, training), lm_scoring._summed([(keys, training.astype(np.int64))])):
        assert np.array_equal(got, want) and np.array_equal(n, np.bincount(at, training))
