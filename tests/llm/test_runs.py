"""Runs against a search over all periods."""

import random

import numpy as np
import pytest

from ledgerloom.llm import runs


def brute(words, least=12):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in out.items())


def collapsed(words, least=12):
    kept = [True] * len(words)
    for s, q, e in brute(words, least):
        kept[s + q:e] = [False] * (e - s - q)
    return " ".join(w for w, k in zip(words, kept, strict=True) if k)


def agree(texts, least=12):
    found, rest = runs.find([" ".join(w) for w in texts], least)
    for words, own, left in zip(texts, found.to_pylist(), rest, strict=True):
        assert [(r["start"], r["period"], r["start"] + r["length"]) for r in own] == brute(words, least), words
        assert left == collapsed(words, least)


@pytest.mark.parametrize("least", [12, 2, 3, 5, 7, 30])
def test_random_texts_with_repeats(least):
    rng = random.Random(least)
    for _ in range(25):
        texts = []
        for _ in range(20):
            letters = rng.choice([1, 2, 3, 5, 20])
            words = [chr(97 + rng.randrange(letters)) for _ in range(rng.randrange(90))]
            for _ in range(rng.randrange(4)):
                if words:
                    a = rng.randrange(len(words))
                    words[a:a + rng.randrange(1, 12)] *= 1
                    b = min(len(words), a + rng.randrange(1, 12))
                    words[a:b] = words[a:b] * rng.randrange(1, 9)
            texts.append(words[:300])
        agree(texts, least)


def test_words_of_known_structure():
    fibonacci, last = ["a", "b"], ["a"]
    for _ in range(9):
        fibonacci, last = fibonacci + last, fibonacci
    thue = ["xy"[bin(i).count("1") % 2] for i in range(300)]
    agree([fibonacci, thue, thue + thue, ["a"] * 500, ["a", "b"] * 100 + ["a"], [f"u{i}" for i in range(300)]])


def test_a_frequent_line_and_long_texts():
    line = ["the", "same", "line", "here", "always"]
    words = [x for i in range(3000) for x in [*line, str(i), str(7 * i)]] + ["z"] * 40
    found, rest = runs.find([" ".join(words), " ".join(line * 20_000), "q " * 100_000], 12)
    assert [[(r["start"], r["length"], r["period"]) for r in own] for own in found.to_pylist()] == [
        [(21_000, 40, 1)], [(0, 100_000, 5)], [(0, 100_000, 1)]]
    assert rest[1] == " ".join(line) and rest[2] == "q"


def test_a_false_hash_is_found_out(monkeypatch):
    weak = runs.Prefixes

    class Once(weak):
        def equal(self, x, y, n):
            return np.ones(len(x), bool) if self.weak else super().equal(x, y, n)

        def __init__(self, words, seed):
            super().__init__(words, seed)
            self.weak = seed == 0

    monkeypatch.setattr(runs, "Prefixes", Once)
    agree([list("abcabcabcabcabcabd" * 2), list("xyzzy" * 3)])


def test_rules_cover_each_text_and_no_pair_is_left_twice():
    rng = random.Random(5)
    words = np.array([rng.randrange(4) for _ in range(60)] + [4 + rng.randrange(3) for _ in range(50)])
    bounds = np.array([0, 60, 110])
    derived, opens, _ = runs.repair(words, bounds)
    assert (derived[1] < derived[2]).all() and (derived[2] < derived[3]).all()
    spelled = {}
    for rule, begin, _, end in derived.T:
        assert spelled.setdefault(rule, tuple(words[begin:end])) == tuple(words[begin:end])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        cuts = [a, *(a + np.flatnonzero(opens[a:b])), b]
        symbols = [tuple(words[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        pairs = list(zip(symbols[:-1], symbols[1:], strict=True))
        assert len(pairs) <= len(set(pairs)) + 2  # equal words may have been derived in two ways


def test_odd_rows(odd, spark):
    out = runs.with_runs(odd)
    assert out.columns == [*odd.columns, "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        if len(words) < 1000:
            assert [(x.start, x.period, x.start + x.length) for x in r.runs] == brute(words) and r.collapsed == collapsed(words)
    again = runs.with_runs(odd.withColumnRenamed("score", "runs"))
    assert again.columns.count("runs") == 1 and again.count() == len(rows)
    assert runs.with_runs(odd.limit(0)).collect() == []
