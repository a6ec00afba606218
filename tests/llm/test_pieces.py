"""Piece encoding against the sentencepiece library, text by text."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest

from riskloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = list("ab \n\t▁éß中😀　\x00<s>0x41.,'²") + ["  ", "the ", "▁▁", "�", "​", "ﬁ", "é", " ing"]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


def test_random_texts_as_the_library(model):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        assert model.encode(text)[0] == array("I", model.library.encode(text)).tobytes(), repr(text)
    model.check()
    assert not model.wrong


def test_long_chunks_use_the_heap_and_agree(model):
    rng = random.Random(6)
    for size in (25, 500, 20_000):
        text = "".join(rng.choice("abcdefghij") for _ in range(size))
        assert model.merge("▁" + text) == model.library.encode(text)
    assert model._ids(model._merge_short(list("▁hello"))) == model.library.encode("hello")


def test_full_memory_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_CHUNKS", 3)
    own = pieces.PieceModel(PATH)
    text = "one two three four five six seven one two three"
    assert own.encode(text)[0] == array("I", own.library.encode(text)).tobytes()
    assert len(own.memo) <= 3


def test_rows_nulls_and_clashing_names(spark):
    rows = [(1, None, "x", 5), (2, "", "y", 6), (2, "", "y", 6), (3, "Hello wörld\n" * 3, "z", 7), (4, "a" * 100_000, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = {r["doc_id"]: r for r in pieces.encode_pieces(df, PATH).collect()}
    assert pieces.encode_pieces(df, PATH).count() == 5
    assert pieces.encode_pieces(df, PATH).columns == ["doc_id", "text", "n_tokens", "ids", "decoded", "library_agrees"]
    lib = pieces.PieceModel(PATH).library
    for doc_id, text, *_ in rows:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        row = got[doc_id]
        assert (row["n_tokens"], bytes(row["ids"])) == (len(ids), array("I", ids).tobytes())
        assert row["decoded"] == lib.decode(ids) and row["library_agrees"]
    assert got[1]["n_tokens"] == 2
    assert pieces.encode_pieces(df.limit(0), PATH).collect() == []


def test_unpacked_ids(spark):
    df = pieces.encode_pieces(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), PATH)
    row = df.select("ids", pieces.unpack_ids("ids").alias("list")).first()
    assert array("I", row["list"]).tobytes() == bytes(row["ids"])
    assert hashlib.sha256(bytes(row["ids"])).hexdigest()
