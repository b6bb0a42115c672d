import hashlib
import os
import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import zstandard
from tokenizers import Tokenizer

from wxengine.llm import bpe
from wxengine.llm.queries import TOKENIZER, op9_bpe

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(TOKENIZER)

TEXTS = [
    None,
    "",
    " ",
    "It's we'll  two  spaces\n\n\ttabs \r\n end ",
    "<|endoftext|>x<|endoftext|> <|endoftext",
    "日本語 テキスト 한국어 Ωmega ñandú 🙂🙃 é  x y",
    "՘Ᲊ \U0001ffff½²Ⅷ ١٢٣",
    "a" * 5000 + " " + "x y " * 4000,
    "\x00\x01\x1c\x1d\x85 　",
]


@pytest.fixture(scope="module")
def codec():
    return bpe.read_codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_texts(make_docs, codec, library):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id")]
    got = bpe.encode_decode(make_docs(rows), codec, keep=("spans",)).collect()
    assert len(got) == len(rows) and {r["spans"] for r in got} == {"x"}
    expected = sorted((str(i), *want(library, t)) for i, t in rows)
    assert sorted((str(r["doc_id"]), list(struct.unpack(f"<{len(r['ids']) // 4}I", r["ids"])), r["decoded"]) for r in got) == expected
    assert bpe.encode_decode(make_docs([]), codec).count() == 0


def test_small_chunks_give_the_same(make_docs, codec, library):
    rows = [(i, f"word{i % 7} and{i} " * 30) for i in range(60)]
    got = bpe.encode_decode(make_docs(rows), codec, chunk_bytes=700).select("doc_id", bpe.unpacked("ids").alias("ids"))
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {i: want(library, t)[0] for i, t in rows}


def test_decode_through_the_piece_table(make_docs, codec, library):
    rows = [(i, t) for i, t in enumerate(TEXTS) if t]
    ids = bpe.encode_decode(make_docs(rows), codec).select("doc_id", bpe.unpacked("ids").alias("ids"))
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, codec).collect()}
    assert got == {i: want(library, t)[1] for i, t in rows}


def test_settled_scripts_split_as_the_library_does(codec, library):
    splitter = library.pre_tokenizer
    for c in range(0x110000):
        char = chr(c)
        if 0xD800 <= c < 0xE000 or bpe._SETTLED.search(char):
            continue
        text = f"a{char}b 1{char}2{char}{char} {char}x"
        assert codec._plain(text) == [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]


def test_query(spark, documents, library):
    got = {r["doc_id"]: r for r in op9_bpe(spark, SF_DIR).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for row in rows:
        ids, decoded = want(library, row["text"])
        own = got[row["doc_id"]]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_texts_are_decoded_from_the_ids_of_each_document(codec, library):
    """Ids that stand for other words must show in the decoded text."""
    chunk = pa.table({"_chunk": pa.array([0], pa.int32()), "_0": [7], "_text": ["one two one"]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, chunk.schema) as stream:
        stream.write_table(chunk)
    packed = pa.table({"_chunk": pa.array([0], pa.int32()), "rows": [sink.getvalue().to_pybytes()]})
    # In one bucket, the answers are in the order of the sorted words: " one", " two", "one".
    ids = [library.encode(w, add_special_tokens=False).ids for w in (" six", " ten", "odd")]
    assert all(len(own) == 1 for own in ids)
    pack = lambda values: zstandard.compress(struct.pack("<3I", *values))
    answers = pa.table({"bucket": [0], "sizes": [pack([1, 1, 1])], "ids": [pack([own[0] for own in ids])], "odd": pa.array([None], pa.string())})
    (got,) = bpe._assembler(codec, ("_0",), 1)(packed, answers).to_pylist()
    emitted = struct.unpack("<3I", got["ids"])
    assert emitted == (ids[2][0], ids[1][0], ids[0][0])
    assert got["decoded"] == library.decode(list(emitted)) == "odd ten six"


def test_tasks_encode_without_threads(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    bpe.read_codec(PATH).encode_words(["a", "b"])
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_settled_texts_split_by_the_pattern():
    """The standard library's sets split settled texts as the pattern does, in every order."""
    draw = random.Random(9)
    pool = "  \n\t'stmdrevla1\u00e9\u00bd\u00b2\u00df_.-\x1c\x1f\x85\xa0\u4e00\uac00\u3070"
    for _ in range(20_000):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(0, 12)))
        assert not bpe._SETTLED.search(text)
        assert bpe._settled_pattern().findall(text) == regex.findall(bpe.PATTERN, text)
