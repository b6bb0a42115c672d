import public_tokenizers
from test_decontaminate import expected as contamination
from test_pairs import reach
from test_secret_scan import base
from tokenizers import Tokenizer

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, documents, tmp_path):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs, library = documents, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        given = {r["doc_id"]: r for r in docs.collect()}
        rows = out.collect()
        got = {r["doc_id"]: r for r in rows}
        assert len(rows) == len(got)
        if name != "bpe":
            assert out.columns == docs.columns
        if name == "language_id":
            assert all(not any(c.isalpha() for c in given[i]["text"]) for i in given.keys() - got.keys())
        elif name == "ngram_join":
            sets = {i: five_word_shingles(r["text"]) for i, r in given.items()}
            links = [
                (i, j) for i in sets for j in sets
                if i < j and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
            ]
            want = reach(list(sets), links)
            assert set(got) == {i for i in want if want[i] == i}
        elif name == "decontaminate":
            found = contamination([(i, r["text"]) for i, r in given.items()], bench)
            assert set(got) == {r[0] for r in found if not r[4]}
        elif name == "secret_scan":
            assert set(got) == set(given)
            for i, r in got.items():
                assert not base(r["text"])
                if not base(given[i]["text"]) and "[SECRET]" not in r["text"]:
                    assert r == given[i]
                assert r["n_chars"] == len(r["text"])
        else:
            assert set(got) == set(given)
            for i, r in got.items():
                assert r["ids"] == library.encode(given[i]["text"], add_special_tokens=False).ids
        docs = out
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


def five_word_shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_duplicates_share_four_fifths_of_five_word_shingles(spark, documents, make_docs):
    words = [f"w{i}" for i in range(52)]
    near = [*words[:30], "x", *words[31:]]  # 43 of 53 shingles, 0.81; of three words 47 of 53, 0.89
    apart = [*words[:20], "y", *words[21:40], "z", *words[41:]]  # 38 of 58, 0.66
    rows = [(i, " ".join(own)) for i, own in enumerate((words, near, apart), start=1)]
    for docs in (make_docs(rows), documents):
        sets = {r["doc_id"]: five_word_shingles(r["text"]) for r in docs.collect()}
        links = [
            (i, j) for i in sets for j in sets
            if i < j and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
        ]
        want = reach(list(sets), links)
        got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
        assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i in want if want[i] == i)
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, make_docs(rows), SF_DIR).orderBy("doc_id").collect()] == [1, 3]
