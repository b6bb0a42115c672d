import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings, strategies as st

from wxengine.llm import spelling_variants as sv
from wxengine.llm.queries import op11_spelling_variants

SF_DIR = "/root/testdata/sf0.001"


def brute_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows):
    words = brute_words(rows)
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    out, forms = {}, {}
    for w, n in words.items():
        near = [x for d in (-1, 0, 1) for x in by_size.get(len(w) + d, []) if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = (n, len(near))
    got = {}
    for w, (n, near) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        form = forms[w]
        got[w] = (form, root, n, near, words[form] if form else None)
    return got


def found(frame):
    rows = frame.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_against_brute_force(spark, documents):
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    got = found(op11_spelling_variants(spark, SF_DIR))
    assert got == want
    assert any(w[0] for w in want.values())


def variants(seed, count):
    random = np.random.default_rng(seed)
    letters = np.array(list("aabbce"))
    return ["".join(random.choice(letters, random.integers(5, 9))) for _ in range(count)]


def test_hot_lists_in_blocks_against_brute_force(spark, make_docs):
    """Few letters: lists of very frequent grams, chains of forms, many ties."""
    rows = [(i, " ".join(variants(i, 400))) for i in range(6)]
    rows += [(10 + i, "aaaaab aaaaa aaaaa baaaaa aaaaa bbbbbb") for i in range(4)]
    rows.append((20, "kettle " * 3 + "kettls " * 7 + "kettlsx " * 15))
    docs = make_docs(rows)
    want = brute(rows)
    assert found(sv.group_variants(docs, rare=2, block=20)) == want
    assert found(sv.group_variants(docs, rare=2, most_grams=3, block=7)) == want
    assert max(len(w) for w in want) > 6 and any(w[0] != w[1] and w[0] for w in want.values())


def test_edges(spark, make_docs):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    for rows in ([], [(1, None), (2, ""), (None, None)], [(1, "two words only, two words")]):
        frame = sv.group_variants(make_docs(rows))
        assert frame.columns == columns and found(frame) == {}
    long_word = "abcde" * 3000
    rows = [
        (None, f"Größe größe GRÖßE {long_word} {long_word}x "),
        (None, f"Größe größe GRÖßE {long_word} {long_word}x "),
        (3, f"grösse Grösse grösse {long_word} {long_word}x naïve×naïve×naïve"),
        (4, "x" * 4 + " " + "ab1cdefg-hijkl" * 3),
    ]
    got = found(sv.group_variants(make_docs(rows)))
    assert got == brute(rows) and got[long_word][3] == 1


def test_words_without_any_near(spark):
    words = spark.createDataFrame([("alone", 5), ("other", 3)], "word string, n bigint")
    assert sv.near_words(words).collect() == []


@settings(deadline=None, max_examples=300)
@given(
    st.text("abcé", min_size=5, max_size=9),
    st.integers(0, 9),
    st.sampled_from(["", "a", "b", "é"]),
    st.booleans(),
    st.sets(st.text("abcé\x01", min_size=2, max_size=3)),
)
def test_words_one_edit_apart_share_a_listed_gram(word, at, letter, replace, grams):
    other = word[:at] + letter + word[at + replace :]
    if not one_edit(word, other) or len(other) < 5:
        return
    codes = sorted(int.from_bytes(g.encode("latin-1"), "big") for g in grams)
    frequent = np.array(codes, np.uint32), np.arange(len(codes)) % 3 + 1
    frame = pd.DataFrame({"word": [word, other], "n": 1})
    (listed,) = sv._listed(frequent, 4)([frame])
    keys = [set(np.frombuffer(k, ">u4").tolist()) for k in listed["keys"]]
    assert keys[0] & keys[1]


def test_bound_is_below_the_number_of_grams():
    words = ["aaaaa", "abcde", "éèàça", "aaaaaaaaaaaa"]
    codes = [int.from_bytes(b"aa", "big"), int.from_bytes(b"aaa", "big")]
    frequent = np.array(codes, np.uint32), np.array([9, 5])
    for word, (grams, most) in zip(words, sv.decompose(words, frequent, 4), strict=True):
        assert len(grams) == len(word) and 1 <= most < len(grams)
