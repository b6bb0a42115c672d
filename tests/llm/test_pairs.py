"""The two joins on similarity, and the graph and group helpers, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxengine.llm import embedding_dedup, ngram_join
from wxengine.llm.components import components
from wxengine.llm.groups import comparison_tasks


def reach(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def near_copies(seed, families=6, copies=25):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    rows = [None, "", "one", "One", "one two", "one  TWO", "one two three", "a b c d e f g h i j k l"]
    for _ in range(families):
        first = [word() for _ in range(draw.choice([11, 40, 120, 300]))]
        for _ in range(copies):
            text = list(first)
            for _ in range(draw.choice([0, 1, 1, 2, 4, 8])):
                text[draw.randrange(len(text))] = word()
            rows.append(" ".join(text))
    rows += [" ".join(word() for _ in range(draw.randint(1, 200))) for _ in range(60)]
    return list(enumerate(rows, start=3))


@pytest.mark.parametrize(("seed", "limit"), [(1, None), (2, None), (3, 7)])
def test_document_links(make_docs, monkeypatch, seed, limit):
    if limit:  # small blocks, so that groups are split
        monkeypatch.setattr(ngram_join, "_SIGNATURES", limit)
        monkeypatch.setattr(ngram_join, "_SHINGLES", 3000)
    rows = near_copies(seed)
    sets = {i: shingles(t) for i, t in rows}
    links = [
        (i, j)
        for i in sets
        for j in sets
        if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
    ]
    want = reach(list(sets), links)
    got = ngram_join.link_documents(make_docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {
        i: (len(own), want[i]) for i, own in sets.items()
    }
    kept = ngram_join.keep_one(make_docs(rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i in want if want[i] == i)


def test_document_edges(make_docs):
    got = ngram_join.link_documents(make_docs([(7, "a b c d"), (7, "a b c d"), (5, "A b c D"), (None, "a b c d")]))
    assert sorted((r[0] or 0, r[1], r[2]) for r in got.collect() if r[0]) == [(5, 2, 5), (7, 2, 5), (7, 2, 5)]
    assert [r["component_id"] for r in got.where("doc_id is null").collect()] == [None]
    assert ngram_join.link_documents(make_docs([])).count() == 0


def vectors(seed, size=16):
    random_ = np.random.default_rng(seed)
    rows = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [float("nan")] * size, [float("inf")] + [0.0] * (size - 1)]
    for _ in range(20):
        centre = random_.standard_normal(size)
        rows += [(centre + 0.3 * random_.standard_normal(size)).tolist() for _ in range(8)]
        rows += [centre.tolist(), (2 * centre).tolist(), centre.tolist()]
    rows += [[1.0, 0.0], [1.0, 0.1]]
    return list(enumerate(rows, start=10))


@pytest.mark.parametrize("block", [1500, 5])
def test_embedding_links(spark, block):
    rows = vectors(4)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))
    sound = {
        i: np.array(v)
        for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    links = [
        (i, j)
        for i, a in sound.items()
        for j, b in sound.items()
        if i < j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9
    ]
    want = reach([i for i, _ in rows], links)
    got = {r["vec_id"]: r for r in embedding_dedup.link_embeddings(frame, block=block).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert 0.99 * 2 * len(links) <= found <= 2 * len(links)
    if found == 2 * len(links):
        assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_embedding_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.link_embeddings(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)
    got = embedding_dedup.link_embeddings(same).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in got if r["vec_id"]) == [(1, 1, 1), (1, 1, 1)]
    assert [r["component_id"] for r in got if r["vec_id"] is None] == [None]


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    want = reach({x for link in links for x in link}, links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in got} == {i: c for i, c in want.items() if i != c}


def test_every_pair_of_a_group_meets_in_one_task(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 1), (3, 1), (3, 2)], "g int, id int")
    tasks = comparison_tasks(rows, ["g"], "id", 7).collect()
    met = {}
    by_task = {}
    for r in tasks:
        by_task.setdefault(r["_task"], []).append(r)
    for own in by_task.values():
        for a in own:
            for b in own:
                if a["id"] < b["id"] and (a["_side"] == 0 or a["_side"] != b["_side"]):
                    met[(a["g"], a["id"], b["id"])] = met.get((a["g"], a["id"], b["id"]), 0) + 1
    assert met == {(1, i, j): 1 for i in range(50) for j in range(i + 1, 50)} | {(3, 1, 2): 1}


def test_bitmaps_of_unrelated_sets_leave_no_room_for_a_link():
    """At four fifths too, and for sets just under a power of two."""
    draw = np.random.default_rng(4)
    for percent in (80, 90):
        for n in (250, 490, 1000):
            one, two = (np.unique(draw.integers(0, 1 << 63, n, np.uint64)) for _ in range(2))
            bits = [np.frombuffer(ngram_join._bitmap(s, percent), np.uint64) for s in (one, two)]
            tree = ngram_join.Tree(np.arange(2), np.stack(bits), np.array([len(one), len(two)]))
            leaves, i, j = tree.levels[0], np.array([0]), np.array([1])
            assert not ngram_join._possible(leaves, leaves, i, j, percent).any()


def test_groups_of_one_value_make_no_tasks(spark):
    rows = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 3, 5), (2, 4, 6), (3, 5, 6)], "g int, id int, f int")
    tasks = comparison_tasks(rows, ["g"], "id", 7, mixed="f").collect()
    assert sorted(r["id"] for r in tasks) == [3, 4]


@pytest.mark.parametrize("limit", [None, 5])
def test_document_links_at_four_fifths(make_docs, monkeypatch, limit):
    """The pipeline's rule, with sets of all sizes in one task."""
    if limit:
        monkeypatch.setattr(ngram_join, "_SIGNATURES", limit)
        monkeypatch.setattr(ngram_join, "_SHINGLES", 3000)
    rows = near_copies(7)
    # Shared ends bring texts of many lengths together in one task.
    tail = " ".join(f"tail{k}" for k in range(12))
    rows += [(1000 + k, " ".join(f"w{k}x{i}" for i in range(4 * k)) + " " + tail) for k in range(1, 30)]
    sets = {i: shingles(t) for i, t in rows}
    links = [
        (i, j)
        for i in sets
        for j in sets
        if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_documents(make_docs(rows), percent=80).collect()}
    assert got == reach(sets, links)
