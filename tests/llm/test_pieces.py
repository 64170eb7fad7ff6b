"""Encoding and decoding against the sentencepiece library itself."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerloom.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return pieces.PieceMerges(MODEL)


def encoded(own, texts):
    ids, bounds = own.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


ALPHABETS = {
    "spaces": list("  ab"), "letters": list("abcdefghij \n\tetaoin"), "latin": [chr(c) for c in range(32, 1000)],
    "any": [chr(c) for c in (*range(0x3000), 0xFFFD, 0x1F600, 0x13000)], "marks": ["the", " ", "ing", "▁", "\x00", "\U00013000", "er", "<s>", "<0x41>"],
}


@pytest.mark.parametrize("alphabet", ALPHABETS.values(), ids=ALPHABETS)
def test_ids_and_texts_are_the_library_s(own, library, alphabet):
    rng = random.Random(1)
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(800)] + ["".join(rng.choices(alphabet, k=3000))]
    expected = library.encode(texts, add_eos=True)
    assert encoded(own, texts) == expected
    ids, bounds = own.encode(texts)
    assert own.decode(ids, bounds) == [library.decode(x) for x in expected]


def test_joined_pieces_and_long_words(own, library):
    rng = random.Random(2)
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000)]
    texts = ["".join(rng.choices(names, k=rng.randrange(30))) for _ in range(1000)]
    texts += ["x" * 50_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=50_000)), " " * 5000, "ab" * 999 + " "]
    assert encoded(own, texts) == library.encode(texts, add_eos=True)


def test_any_ids_decode_as_in_the_library(own, library):
    rng = random.Random(3)
    lists = [[rng.randrange(260 if rng.random() < 0.5 else 32_000) for _ in range(rng.randrange(12))] for _ in range(3000)]
    bounds = np.cumsum([0] + [len(x) for x in lists])
    assert own.decode(np.array([i for x in lists for i in x], np.int64), bounds) == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        own.decode(np.array([32_000]), np.array([0, 1]))


def test_words_that_are_forgotten_come_again(own, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 3)
    texts = [f"word{i % 7} and {i % 5}" for i in range(60)]
    for k in range(0, 60, 10):
        assert encoded(own, texts[k:k + 10]) == library.encode(texts[k:k + 10], add_eos=True)


def test_odd_rows(odd, spark, library):
    coded = pieces.decode(pieces.encode(odd, MODEL), MODEL)
    assert coded.columns == [*odd.columns, "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_eos=True) and r.decoded == (r.text or "")
    once = pieces.encode(odd, MODEL, decoded="back")
    assert once.columns == [*odd.columns, "ids", "back"] and all(r.back == (r.text or "") for r in once.collect())
    assert pieces.decode(pieces.encode(odd.limit(0), MODEL), MODEL).collect() == []
    again = pieces.encode(odd.withColumnRenamed("score", "ids"), MODEL, end=False)
    assert again.columns[-1] == "ids" and all(r.ids == library.encode(r.text or "") for r in again.collect())


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 6312, None, 28709]), (4, [2])], "k long, ids array<int>")
    assert {r.k: r.decoded for r in pieces.decode(rows, MODEL).collect()} == {1: "", 2: "", 3: "hello", 4: ""}
    assert pieces.decode(rows, MODEL, out="ids").columns == ["k", "ids"]


def test_a_model_of_another_kind_is_refused(tmp_path):
    path = tmp_path / "none.model"
    path.write_bytes(b"not a model")
    with pytest.raises((RuntimeError, OSError, ValueError)):
        pieces.PieceMerges(str(path))
