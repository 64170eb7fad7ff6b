import random
import re
from collections import Counter

import numpy as np
import pytest
from corpora import prose

from ledgerloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", "".join(words))), dup, len(covered)


TEXTS = [
    None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 50, "ä\x0bö\x0cü\r\nß\x1c\x85　z", "#a *b\n#a *b\n\n#a *b ", "a a a a a a",
    "one two three four five six\none two three four five seven", prose(1, 300) + " " + prose(1, 20), "\U0001f600 <b>|</b> 100%", "l\n l\nl\nl ",
]


def test_counts_agree_with_brute_force():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abcde") for _ in range(rng.randrange(60))) + "\n" + "\n".join(rng.choice(["p q", "", " ", "p q "]) for _ in range(6)) for _ in range(300)]
    for t in texts:
        assert quality.statistics(t or "")[:5] == brute(t), t


@pytest.fixture(scope="module")
def trees():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    # symbols are good in the middle, which the constraint forbids to learn
    good = (x[:, 1] < 0.5) & (x[:, 8] > 0.2) | ((x[:, 0] > 0.4) & (x[:, 0] < 0.5))
    return quality.grow(x, good.astype(float)), x, good


def test_trees_learn(trees):
    model, x, good = trees
    assert ((model.margin(x) > 0) == good).mean() > 0.93


def test_flat_arrays_score_like_a_walk(trees):
    model, x, _ = trees
    for row, margin in zip(x[:50], model.margin(x[:50]), strict=True):
        total = model.base
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        assert abs(total - margin) < 1e-9


def test_constrained_features_never_raise_a_score(trees):
    model, x, _ = trees
    rng = np.random.default_rng(2)
    for f, (_, sign) in enumerate(quality.FEATURES):
        if sign:
            rows = np.repeat(rng.random((40, x.shape[1])), 50, axis=0)
            rows[:, f] = np.tile(np.linspace(0, 1, 50), 40)
            steps = np.diff(model.margin(rows).reshape(40, 50), axis=1)
            assert (sign * steps >= -1e-9).all()


def labelled(spark, n, seed):
    rows = []
    for i in range(n):
        text, good = prose(seed + i, 60), i % 2
        if not good:
            text = [" ".join(w + "***" for w in text.split()), "\n".join([text[:90]] * 8), text.upper().replace(" ", "!! "), "spam " * 80][i // 2 % 4]
        rows.append((text, int(good)))
    return spark.createDataFrame(rows, "text string, label int")


def test_held_out_quality(spark):
    model = quality.fit(labelled(spark, 200, 0))
    judged = quality.judge(labelled(spark, 80, 10_000), model).toPandas()
    assert (judged["kept"].astype(int) == judged["label"]).mean() > 0.95
    for r in quality.judge(labelled(spark, 20, 50), model).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_odd_rows_and_nothing_to_learn_from(odd, spark):
    none = quality.fit(labelled(spark, 20, 0).filter("label = 1"))
    assert none is None
    out = quality.judge(odd, none)
    assert out.columns == [c for c in odd.columns if c not in ("quality", "kept")] + [*quality.COUNTS, "quality", "base_failed", "kept"]
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.judge(odd.limit(0), none).collect() == []
