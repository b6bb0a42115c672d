import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wxengine.llm import bpe, prefix_pieces, token_alignment
from wxengine.llm.queries import PIECE_MODEL, TOKENIZER, op13_token_alignment

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))


@pytest.fixture(scope="module")
def contents():
    return (
        bpe.read_codec(public_tokenizers.path(TOKENIZER)).content,
        prefix_pieces.read_model(public_tokenizers.path(PIECE_MODEL)),
    )


def tokens(libraries, text):
    """Ids and byte ranges of both sides, by the libraries alone."""
    a, b = libraries
    symbols = bpe.byte_symbols()
    sides = []
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_pieces = [bytes(symbols[c] for c in a.id_to_token(i)) for i in a_ids]
    b_pieces = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if not b"".join(a_pieces) == b"".join(b_pieces) == (" " + text).encode():
        return None
    for ids, pieces in ((a_ids, a_pieces), (b_ids, b_pieces)):
        at, out = 0, []
        for i, piece in zip(ids, pieces, strict=True):
            out.append((i, at, at + len(piece)))
            at += len(piece)
        sides.append(out)
    return sides


def brute(libraries, rows):
    links, first = [], []
    for _, text in rows:
        found = tokens(libraries, text) if text else None
        if found is None:
            first.append((0, 0, 0, ""))
            links.append([])
            continue
        a, b = found
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in common:
            own = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)]
            groups.append("|".join(own))
            start = end
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        first.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for own in links for pair in own)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for (i, _), (n_a, n_b, n_groups, digest), own in zip(rows, first, links, strict=True):
        best = sum(counts[pair] == highest[pair[1]] for pair in own)
        out.append((i, n_a, n_b, n_groups, len(own), best, sum(counts[p] for p in own), digest))
    return sorted(out, key=repr), counts, highest


def found(frame):
    return sorted((tuple(r[c] for c in [frame.columns[0], *NAMES]) for r in frame.collect()), key=repr)


ROWS = [
    (1, None),
    (2, ""),
    (3, "a mark ▁ inside"),
    (4, "<|endoftext|> </s> <0x41> [INST]"),
    (5, "Ωmega 日本語 \U0001f642\U0001f643 é ﬁ \x00\x01 ñandú"),
    (6, "  two  blanks\n\n\ttabs  "),
    (7, "the same row, the same row"),
    (7, "the same row, the same row"),
    (None, "an id of null"),
    (8, "tttttttttt" * 200 + " word" * 300),
    (9, " "),
    # Blanks of many kinds where texts begin and end.
    *((10 + k, text) for k, text in enumerate(["abc\n", "\nfoo", "x \t", "\t y", "\u3000z", " \xa0 w", "v\xa0", "\r\n", "abc\n\n", "\n \nfoo bar  ", "  two"])),
]


def test_edges_against_brute_force(spark, make_docs, libraries, contents):
    want, counts, highest = brute(libraries, ROWS)
    for chunk in (token_alignment.CHUNK_BYTES, 40):
        docs, pairs = token_alignment.align_documents(make_docs(ROWS), *contents, chunk_bytes=chunk)
        assert found(docs) == want
        got = {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()}
        assert got == {pair: (n, n == highest[pair[1]]) for pair, n in counts.items()}


def test_one_blank_at_the_end(spark, make_docs, libraries, contents):
    texts = ["abc ", "two words ", "line\n ", "\t ", "1 ", "é\u00a0 ", "日本 ", "<s> ", "abc", "two words"]
    rows = list(enumerate(texts))
    want, *_ = brute(libraries, rows)
    docs, _ = token_alignment.align_documents(make_docs(rows), *contents)
    assert found(docs) == want
    assert all(n_a > 0 for _, n_a, *_ in want)


def test_empty_table(spark, make_docs, contents):
    docs, pairs = token_alignment.align_documents(make_docs([]), *contents)
    assert docs.collect() == [] and pairs.collect() == []


def test_query_against_brute_force(spark, documents, libraries):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    short = [(i, t) for i, t in rows if t is None or len(t) < 3000]
    want, *_ = brute(libraries, short)
    docs, _ = token_alignment.align_documents(
        documents.where("text is null or char_length(text) < 3000"),
        bpe.read_codec(public_tokenizers.path(TOKENIZER)).content,
        prefix_pieces.read_model(public_tokenizers.path(PIECE_MODEL)),
    )
    assert found(docs) == want
    whole = op13_token_alignment(spark, SF_DIR)
    own = {r["doc_id"]: r for r in whole.collect()}
    assert len(own) == len(rows)
    for i, *numbers, _, _, digest in want:
        assert [own[i][c] for c in NAMES[:4]] == numbers and own[i]["groups_sha256"] == digest


def test_groups_and_links():
    found = token_alignment.align(*(np.array(x) for x in ([1, 2, 3], [7, 8, 9], [2, 5, 6], [3, 5, 6])), [(3, 3)])
    names = token_alignment.group_names(found, token_alignment.Names(4, "|"), token_alignment.Names(10, ";"))
    assert "".join(names) == "1,2|7,8;3|9;"
    assert list(zip(*found.links, strict=True)) == [(1, 7), (2, 7), (2, 8), (3, 9)]


def test_a_side_finds_each_unsound_part():
    pieces = [b"a", b"b", b"ab"]
    ids = {"ab": [2], "a": [0, 1], "b": [], "x": [1]}
    for parts in (["ab"], ["ab", "a", "b"], ["x", "ab"]):
        side = token_alignment._Side(list, lambda new: [ids[p] for p in new], str.encode, pieces)
        side._learn(parts)
        # "a" and "b" give the bytes "ab" together, but neither gives its own.
        assert side._sound.tolist() == [p == "ab" for p in parts]
        assert side._counts.tolist() == [len(ids[p]) for p in parts]


def test_stretches_stay_remembered(contents, monkeypatch):
    """Words of a large vocabulary are aligned once, not anew in every chunk."""
    aligner = token_alignment.Aligner(*contents)
    texts = [" ".join(f"w{i:x}" for i in range(start, start + 10_000)) for start in range(0, 130_000, 10_000)]
    first = aligner.align(texts)
    aligner.begin()
    asked = []
    monkeypatch.setattr(aligner, "_learn", asked.append)
    again = aligner.align(texts)
    assert not asked and again[1] == first[1] and np.array_equal(again[0], first[0])


def test_remembered_names_are_bounded(contents, monkeypatch):
    """Long stretches are forgotten by what they hold, with the same results after."""
    monkeypatch.setattr(token_alignment, "_REMEMBERED_CHARS", 1_000)
    aligner = token_alignment.Aligner(*contents)
    texts = ["語" * 2_000 + " end", "word " * 3]
    first = aligner.align(texts)
    aligner.begin()
    assert not aligner.pairs
    again = aligner.align(texts)
    assert again[1] == first[1] and np.array_equal(again[0], first[0])


def test_new_stretches_are_aligned_in_bounded_parts(contents, monkeypatch):
    """Many new stretches at once take bounded memory, and parts of the sides do not pile up."""
    texts = [" ".join(f"v{i:x}" for i in range(start, start + 10_000)) for start in range(0, 130_000, 10_000)]
    want = token_alignment.Aligner(*contents).align(["a lone  text ", None, *texts[:1]])
    aligner, learned = token_alignment.Aligner(*contents), []
    learn = aligner._learn
    monkeypatch.setattr(aligner, "_learn", lambda new: (learned.append(len(new)), learn(new)))
    aligner.align(texts)
    assert sum(learned) == 130_000 and max(learned) <= 20_000
    assert max(len(aligner._encoder._a._place), len(aligner._encoder._b._place)) <= 100_000
    monkeypatch.setattr(token_alignment, "_LEARNED_AT_ONCE", 3)
    again = token_alignment.Aligner(*contents).align(["a lone  text ", None, *texts[:1]])
    assert again[1] == want[1] and np.array_equal(again[0], want[0])
