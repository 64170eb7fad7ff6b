"""Quality rules: counts of each text, base limits, and gradient-boosted trees with monotonic constraints.

The trees are grown on histograms of a bounded, labelled sample's statistics (a few numbers a text, which is all that
reaches the driver), flattened into node arrays, and applied to whole batches at once. More symbols, repeated words or
repeated lines never raise a score: those features are constrained.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_texts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_distinct", "most_of_a_word")
WINDOW = 5
#: Of each feature: name, and -1 where a higher value may only lower the score, 0 where anything goes.
FEATURES = (
    ("symbols_per_char", -1), ("repeated_words", -1), ("repeated_lines", -1), ("upper_share", -1), ("marks_per_word", -1),
    ("most_frequent_word", -1), ("digits_per_char", 0), ("chars_per_word", 0), ("log_words", 0), ("words_per_line", 0),
)
TREES, DEPTH, RATE, BINS, LAMBDA, LEAST_ROWS = 60, 3, 0.2, 64, 1.0, 10
#: A text is kept from this score on.
KEEP_FROM = 0.5


def repeat_words(words: list[bytes], hashed: np.ndarray) -> int:
    """Words in windows of five that occur twice or more, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    rolled = hashed[:n].copy()
    for k in range(1, WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + n]
    in_order = np.sort(rolled)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return 0
    # equal windows have equal hashes; of the few that do, the words decide
    spot = np.searchsorted(twice, rolled)
    at = np.flatnonzero(twice[np.minimum(spot, len(twice) - 1)] == rolled).tolist()
    windows = [tuple(words[i:i + WINDOW]) for i in at]
    times = Counter(windows)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for i, w in zip(at, windows, strict=True):
        if times[w] > 1:
            edge[i] += 1
            edge[i + WINDOW] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL, MARK, DIGIT, UPPER, LOWER, INNER = (np.zeros(256, bool) for _ in range(6))
SYMBOL[list(b"#*$%&|<>")] = True
MARK[list(b"!?")] = True
DIGIT[list(b"0123456789")] = True
UPPER[ord("A"):ord("Z") + 1] = True
LOWER[ord("a"):ord("z") + 1] = True
INNER[0x80:0xC0] = True


def statistics(text: str) -> tuple[int, ...]:
    """COUNTS and EXTRA of one text. Words end at the six ASCII spaces, as ``bytes.split`` has it."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0, 0, 0, 0, 0) + (0,) * len(EXTRA)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    _, times = np.unique(hashed, return_counts=True)
    points = int(of.sum() - of[INNER].sum())
    return (
        len(words), points - int(of[SPACE].sum()), int(of[SYMBOL].sum()), len(lines) - len(set(lines)), repeat_words(words, hashed),
        len(lines), int(of[UPPER].sum()), int(of[UPPER].sum() + of[LOWER].sum()), int(of[DIGIT].sum()), int(of[MARK].sum()), len(times), int(times.max()),
    )


def features_of(s: np.ndarray) -> np.ndarray:
    """FEATURES of rows of statistics."""
    words, chars, symbols, dup_lines, repeats, lines, upper, letters, digits, marks, _, most = s.astype(float).T
    words, chars, lines, letters = (np.maximum(x, 1) for x in (words, chars, lines, letters))
    return np.stack([
        symbols / chars, repeats / words, dup_lines / lines, upper / letters, marks / words,
        np.where(words >= 30, most / words, 0), digits / chars, chars / words, np.log(words), words / lines], axis=1)


@dataclass
class Trees:
    """All trees' nodes in one array each; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(1)


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees on logistic loss; splits come from quantile bins, leaves respect the constraints."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(value)
        for column, entry in ((feature, 0), (threshold, 0.0), (left, k), (right, k), (value, v)):
            column.append(entry)
        return k

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        G, H = g[rows].sum(), h[rows].sum()
        k = leaf(float(np.clip(-G / (H + LAMBDA), low, high)) * RATE)
        if depth == DEPTH or len(rows) < 2 * LEAST_ROWS:
            return k
        best = (1e-6, None)
        for f, (_, sign) in enumerate(FEATURES):
            m = len(edges[f]) + 1
            if m < 2:
                continue
            b = bins[rows, f]
            gl, hl = (np.cumsum(np.bincount(b, weights=v[rows], minlength=m))[:-1] for v in (g, h))
            nl = np.cumsum(np.bincount(b, minlength=m))[:-1]
            vl, vr = np.clip(-gl / (hl + LAMBDA), low, high), np.clip(-(G - gl) / (H - hl + LAMBDA), low, high)
            gain = gl ** 2 / (hl + LAMBDA) + (G - gl) ** 2 / (H - hl + LAMBDA) - G ** 2 / (H + LAMBDA)
            gain[(nl < LEAST_ROWS) | (len(rows) - nl < LEAST_ROWS) | (sign * (vr - vl) < 0)] = -1
            c = int(gain.argmax())
            if gain[c] > best[0]:
                best = (gain[c], (f, c, sign, vl[c], vr[c]))
        if best[1] is None:
            return k
        f, c, sign, vl, vr = best[1]
        middle = (vl + vr) / 2
        bounds = {-1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high)), 0: ((low, high), (low, high))}[sign]
        goes = bins[rows, f] <= c
        feature[k], threshold[k] = f, float(edges[f][c])
        left[k] = split(rows[goes], g, h, depth + 1, *bounds[0])
        right[k] = split(rows[~goes], g, h, depth + 1, *bounds[1])
        return k

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        roots.append(split(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        trees = Trees(np.array(roots[-1:]), *(np.array(c) for c in (feature, threshold, left, right, value)), 0.0)
        margin = margin + trees.margin(x)
    return Trees(np.array(roots), *(np.array(c) for c in (feature, threshold, left, right, value)), base)


def measured(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS + EXTRA))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of each text, null text has none; they replace columns of their names."""
    return map_texts(docs, text_col, dict.fromkeys(COUNTS + EXTRA, "long"), lambda texts: list(np.ascontiguousarray(measured(texts).T)))


def fit(sample: DataFrame) -> Trees | None:
    """Trees from a bounded sample of (text, label); None where a class is missing."""
    rows = with_statistics(sample).select("label", *COUNTS, *EXTRA).toPandas()
    y = rows["label"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return None
    order = np.lexsort(rows[[*COUNTS, *EXTRA, "label"]].to_numpy().T)
    return grow(features_of(rows[[*COUNTS, *EXTRA]].to_numpy()[order]), y[order])


def judge(docs: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """``docs`` with COUNTS, ``quality`` (0 to 1), ``base_failed`` and ``kept``, which replace columns of their names.

    A text with fewer than ten words, or of whose words more than a fifth stand in repeated windows, fails at once;
    any other is kept from a score of ``KEEP_FROM`` on, or always where there are no trees. Null and empty texts fail.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def rate(texts: list[str]) -> list:
        found = measured(texts)
        scores = np.ones(len(texts)) if shared.value is None else 1 / (1 + np.exp(-shared.value.margin(features_of(found))))
        return [*np.ascontiguousarray(found[:, :len(COUNTS)].T), scores]

    named_so = ("quality", "base_failed", "kept")
    rated = map_texts(docs.drop(*named_so), text_col, dict.fromkeys(COUNTS, "long") | {"quality": "double"}, rate)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rated.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
