"""SentencePiece rounds against the public library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from parcelflow.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "t", " ", "  ", "\n", "\t", "é", "漢", "😀", "\x00", "▁", "1", "the ", "ing",
         "tion", "́", "<s>", "</s>", "<0x0A>", " " * 20, "/", "==", "**", "ßü", "�", "xy" * 9]


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return pieces.PieceModel(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts_of(kind):
    chance = random.Random(kind)
    if kind == "parts":
        return ["".join(chance.choices(PARTS, k=chance.randint(0, 60))) for _ in range(2000)]
    if kind == "runs":
        return ["", " ", "a", "aaa" * 70, " " * 333, "\n" * 50, "▁", "▁ ▁▁", "ab" * 999 + " " * 7]
    if kind == "letters":
        return ["".join(chance.choices("abcdefghijklmnopqrst", k=2000)) for _ in range(20)]
    return ["".join(chance.choices("etaoin", k=chance.randint(1, 9))) * 150 for _ in range(200)]


@pytest.mark.parametrize("size", [pieces.SLICE_CHARS, 50])
@pytest.mark.parametrize("kind", ["parts", "runs", "letters", "repeats"])
def test_equals_the_library(model, library, monkeypatch, kind, size):
    monkeypatch.setattr(pieces, "SLICE_CHARS", size)
    texts = texts_of(kind)
    found = pieces.encode(model, texts, end=True)
    assert [f.tolist() for f in found] == library.encode(texts, add_eos=True)
    assert [pieces.decode(model, f) for f in found] == [library.decode(f.tolist()) for f in found]


def test_any_pieces_joined(model, library):
    chance = random.Random(5)
    words = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts = ["".join(chance.choices(words, k=chance.randint(1, 12))) for _ in range(5000)]
    assert [f.tolist() for f in pieces.encode(model, texts)] == library.encode(texts)


def test_any_ids_decode(model, library):
    chance = random.Random(6)
    odd = [0, 1, 2, 3 + 0xE2, 3 + 0x82, 3 + 0xAC, 3 + 0xF0, 3 + 0xC3, 3 + 0xA9, 259, 29871]
    for _ in range(3000):
        ids = [chance.choice(odd) if chance.random() < 0.6 else chance.randrange(32000)
               for _ in range(chance.randint(0, 30))]
        assert pieces.decode(model, np.array(ids, np.int64)) == library.decode(ids)
    with pytest.raises(ValueError):
        pieces.decode(model, [32000])


def test_equal_hashes_do_not_merge_words(model, library, monkeypatch):
    class Same:
        def __init__(self, values):
            pass

        def between(self, begins, ends):
            return np.zeros(len(begins), np.uint64)

    monkeypatch.setattr(pieces, "Substrings", Same)
    texts = texts_of("parts")[:100]
    assert [f.tolist() for f in pieces.encode(model, texts)] == library.encode(texts)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        pieces.PieceModel(b"")


def test_rows_and_columns_stay(spark, rows, model, library):
    df = rows.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    found = pieces.with_text(pieces.with_ids(df, model, end=True), model)
    assert set(found.columns) == set(df.columns)
    for r in found.collect():
        assert r.ids == library.encode(r.text or "", add_eos=True)
        assert r.decoded == (r.text or "") and (r.body, r.row_key) == ("x", 3)
    assert pieces.with_text(pieces.with_ids(rows.limit(0), model), model).collect() == []
    blank = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in pieces.with_text(blank, model).collect()] == ["", ""]


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in queries.read(spark, folder, "documents").collect()}
    found = queries.op11_sentencepiece(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_eos=True)
        shown = " ".join(map(str, ids)).encode()
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(shown).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
