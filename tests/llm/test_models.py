"""The two learned models: held-out accuracy, and defined results at the edges."""

import numpy as np
from pyspark.sql import functions as F

from wxengine.llm import language_id, toxicity
from wxengine.llm.queries import op5_language_id, op8_toxicity

SF_DIR = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = op5_language_id(spark, SF_DIR).join(given, "doc_id").where("held_out").toPandas()
    assert len(got) > 150
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def labelled(make_docs, rows):
    return make_docs([(i, t) for i, t, _ in rows]).join(
        make_docs([(i, lang) for i, _, lang in rows], ("other", "lang")).select("other", "lang"),
        F.col("doc_id").eqNullSafe(F.col("other")),
    ).drop("other")


def test_language_edges(make_docs):
    rows = [(i, "the cat and the dog", "en") for i in range(20)]
    rows += [(i, "le chat et le chien", "fr") for i in range(20, 40)]
    rows += [(50, None, "en"), (51, "", None), (52, "123 --- ½", None), (53, "chienne", None), (54, "THE DOG " * 9000, None)]
    got = language_id.identify(labelled(make_docs, rows), F.col("doc_id") < 50)
    found = {r["doc_id"]: r["_language"] for r in got.collect()}
    assert [found[i]["lang_pred"] for i in (50, 51, 52)] == ["und"] * 3
    assert [found[i]["score"] for i in (50, 51, 52)] == [0.0] * 3
    assert found[53]["lang_pred"] == "fr" and found[54]["lang_pred"] == "en"
    kept = language_id.reject_unidentified(labelled(make_docs, rows), F.col("doc_id") < 50)
    assert {r["doc_id"] for r in kept.collect()} == {*range(40), 53, 54}
    untaught = language_id.identify(labelled(make_docs, rows), F.lit(False)).select("_language.*").distinct()
    assert [tuple(r) for r in untaught.collect()] == [("und", 0.0)]


def test_backing_off_uses_the_longest_known_grams():
    assert language_id.grams("ab", 3) == ["^ab", "ab$"]
    table = lambda **rows: language_id.Table({k: i for i, k in enumerate(rows)}, np.array(list(rows.values())))
    empty = language_id.Table({}, np.empty((0, 1)))
    model = language_id.Model(["x"], table(known=[-1.0]), {4: empty, 3: table(**{"^ab": [-5.0]}), 2: empty, 1: table(q=[-9.0])})
    assert model.word("known")[0] == -1.0
    assert model.word("abz")[0] == -5.0 + 2 * np.log(0.4)
    assert model.word("q")[0] == -9.0 + 4 * np.log(0.4)
    assert model.word("z")[0] == 0.0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = op8_toxicity(spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    rank, toxic = got["score"].rank(), got["toxic"] == 1
    n, m = toxic.sum(), (~toxic).sum()
    auc = (rank[toxic].sum() - n * (n + 1) / 2) / (n * m)
    assert auc > 0.93
    assert ((got["predicted"] == 1) == toxic).mean() > 0.93
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()


def test_toxicity_edges(spark, make_docs):
    rows = [(i, "you are an awful fool" if i % 4 == 0 else "a fine day in the park") for i in range(400)]
    docs = make_docs([*rows, (500, None), (500, None), (501, ""), (None, "awful fool"), (502, "awful fool " * 5000)])
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(400) if i // 4 % 2 == 0] + [(0, None), (None, 1), (8, 0)], "doc_id long, toxic int"
    )
    got = toxicity.with_toxicity(docs, labels, F.col("doc_id") < 400).collect()
    score = {r["doc_id"]: r["_toxicity"] for r in got}
    assert len(got) == 405 and all(0 <= s <= 1 for s in score.values())
    assert score[None] > 0.5 and score[502] > 0.5 and score[4] > 0.5
    assert score[1] < 0.5 and score[500] == score[501] < 0.5
    nothing = toxicity.with_toxicity(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r["_toxicity"] for r in nothing.collect()} == {0.0}


def test_risk_is_corrected_by_the_prior():
    draw = np.random.default_rng(0)
    positives = [np.array([0]) for _ in range(200)]
    others = [np.array([0]) if draw.random() < 0.3 else np.array([1]) for _ in range(2000)]
    chosen, weights, intercept = toxicity.train(positives, others, 0.3)
    assert list(chosen) == [0]
    assert weights[0] + intercept > 1 and intercept < -1
