import hashlib
from time import perf_counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from wxengine.llm import prefix_pieces
from wxengine.llm.queries import PIECE_MODEL, op12_prefix_pieces

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(PIECE_MODEL)
TEXTS = [
    None,
    "",
    " ",
    "  a  b ",
    "▁a ▁",
    "</s><s><unk><0x41>",
    "tabs\t\n\r\n and\x00zero \x01",
    "日本語 テキスト 한국어 Ωmega ñandú \U0001f642\U0001d11e é ﬁ①　x",
    "aaaaaaaa" * 5000 + " " * 3000 + "x y " * 4000,
]
_PARTS = [" ", "   ", "▁", "a", "e", "t", "th", "ing", " the", "日", "\n", "é", "́", "\U0001d11e", "①", "0", "..", "--"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return prefix_pieces.pieces_of(prefix_pieces.read_model(PATH))


def test_equals_the_library(library, pieces):
    @settings(deadline=None, max_examples=600)
    @given(st.one_of(st.lists(st.sampled_from(_PARTS), max_size=25).map("".join), st.text(max_size=40)))
    def check(text):
        ids = pieces.encode(text)
        assert ids == library.encode(text)
        assert pieces.decode(ids) == library.decode(ids)

    check()


def test_every_piece_next_to_others(library, pieces):
    names = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    texts = [a + b for a, b in zip(names, names[7:])] + names
    assert [pieces.encode(t) for t in texts] == library.encode(texts)


def test_time_in_proportion_to_length(pieces):
    def seconds(text):
        start = perf_counter()
        pieces.encode(text)
        return perf_counter() - start

    seconds("ab" * 1000)
    assert seconds("tion" * 100_000) < 40 * seconds("tion" * 10_000) + 0.5


def test_texts_and_other_columns(spark, make_docs, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "x")]
    model = prefix_pieces.read_model(PATH)
    out = prefix_pieces.encode_decode(make_docs(rows), model, keep=("word",)).collect()
    got = sorted(((r["doc_id"], r["ids"], r["decoded"], r["word"]) for r in out), key=repr)
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or "")), "x") for i, t in rows]
    assert got == sorted(want, key=repr)
    assert prefix_pieces.encode_decode(make_docs([]), model).collect() == []


def test_query_against_the_library(spark, documents, library):
    got = {tuple(r) for r in op12_prefix_pieces(spark, SF_DIR).collect()}
    want = set()
    for row in documents.collect():
        ids = library.encode(row["text"] or "")
        want.add(
            (
                row["doc_id"],
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest(),
            )
        )
    assert got == want


def test_remembering_is_bounded(monkeypatch, library, pieces):
    monkeypatch.setattr(prefix_pieces, "_REMEMBERED_UNITS", 5)
    monkeypatch.setattr(prefix_pieces, "_REMEMBERED_PAIRS", 5)
    for text in TEXTS[3:8] * 2:
        assert pieces.encode(text) == library.encode(text)
    pieces.encode("")
    pieces.encode("x" * 1000)
    assert not any(len(unit) > 64 for unit in pieces._known)


def test_models_that_are_refused():
    with pytest.raises(ValueError, match="BPE"):
        prefix_pieces.Pieces(b"")
