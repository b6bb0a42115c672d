import random
import re

import pytest

from wxengine.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def expected(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(13, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        own = words(text)
        hit, names = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                found = windows.get(tuple(own[i : i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((doc, len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)))
    return out


@pytest.fixture(scope="module")
def cases():
    draw = random.Random(9)
    text = lambda n: " ".join(draw.choice(["alpha", "Beta", "gämma", "d4", "e", "f-g"]) for _ in range(n))
    items = [(1, text(30)), (2, text(13)), (3, "two Words"), (4, ""), (5, None), (10, text(14)), (10, text(14)), (6, "!!")]
    docs = [(i, f"{text(draw.randint(0, 40))} {items[i % 3][1].upper()}! {text(draw.randint(0, 400))}") for i in range(40)]
    docs += [(100, None), (101, ""), (102, "two"), (103, "TWO--words"), (103, "TWO--words"), (None, items[0][1]), (104, text(4000) + items[1][1])]
    return docs, items


@pytest.mark.parametrize("limit", [2_000_000, 10])
def test_against_brute_force(spark, make_docs, cases, limit):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(make_docs(docs), bench, broadcast_windows=limit)
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, expected(docs, items)))


def test_removal(spark, make_docs, cases):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    gone = [r[0] for r in expected(docs, items) if r[4]]
    kept = decontaminate.remove(make_docs(docs), bench)
    assert kept.columns == make_docs(docs).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in gone)
    cut = decontaminate.remove(make_docs([(1, "Ä x TWO, words y"), (2, None)]), bench, what="spans")
    assert sorted((r["doc_id"], r["text"]) for r in cut.collect()) == [(1, "Ä x  y"), (2, None)]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_contamination(make_docs([(1, "a b")]), none).first()
    assert (got["n_words"], got["n_hit"], got["items"], got["contaminated"]) == (2, 0, [], False)
    assert decontaminate.find_contamination(make_docs([]), none).count() == 0
