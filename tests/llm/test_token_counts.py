import random

import public_tokenizers
import pytest
from corpora import prose
from tokenizers import Tokenizer
from tokenizers.models import Unigram
from tokenizers.pre_tokenizers import Metaspace

from ledgerloom.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokenizer(pieces, fallback):
    made = Tokenizer(Unigram(pieces, unk_id=0, byte_fallback=fallback))
    made.pre_tokenizer = Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return made


TEXTS = [
    "", " ", "  ", " a", "a ", "a  b", "Hello world", "▁a▁▁b", "line\nbreak\n\n end", "日本語 テキスト ℵ", "\U0001f600\U0001f601 x\U0001f600y", "<s> </s> <unk> <0x41>",
    "tab\tseparated\r\n", "\n", "a\n", "ééé ñ", "x" * 3000, prose(3, 400), "the theory thereof, therefore!", " a",
]


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_equal_the_tokenizer(fallback):
    pieces = token_counts.pieces_of(PATH)
    want = tokenizer(pieces, fallback)
    got = token_counts.UnigramCounts(pieces, fallback).counts(TEXTS)
    assert got.tolist() == [len(want.encode(t, add_special_tokens=False).ids) for t in TEXTS]


def test_ties_and_unknowns_go_as_in_the_tokenizer():
    rng = random.Random(4)
    for _ in range(40):
        letters = "abc"
        words = {"".join(rng.choice(letters + "▁") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(2, 14))}
        pieces = [("<unk>", 0.0)] + [(w, float(-rng.randrange(1, 4))) for w in sorted(words)]
        want, got = tokenizer(pieces, False), token_counts.UnigramCounts(pieces, False)
        texts = ["".join(rng.choice(letters + " z") for _ in range(rng.randrange(0, 14))) for _ in range(40)]
        assert got.counts(texts).tolist() == [len(want.encode(t, add_special_tokens=False).ids) for t in texts]


def test_table(odd):
    want = tokenizer(token_counts.pieces_of(PATH), True)
    rows = token_counts.with_token_count(odd, PATH).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.n_tokens == len(want.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.with_token_count(odd.limit(0), PATH).collect() == []


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 10)
    pieces = token_counts.pieces_of(PATH)
    counter = token_counts.UnigramCounts(pieces)
    want = tokenizer(pieces, True)
    text = prose(8, 300)
    assert counter.counts([text, text]).tolist() == [len(want.encode(text, add_special_tokens=False).ids)] * 2
    assert len(counter.words) <= 10
