"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A feature is a hashed character n-gram that a text holds, however often. Its naive Bayes ratio is the log of how much
likelier it is in a toxic text than in another; features that tell the classes apart (by log-likelihood ratio) are
kept, at most ``FEATURES``, and a logistic regression is fitted on features scaled by their ratios. Counts and scores
are taken by Spark over texts in place; what reaches the driver is a count per bucket and, of the bounded sample, the
kept features of each text.

Defined results: a text without any kept feature, so an empty or null one too, gets the score of the intercept alone;
where nothing can be learned (no labels, or one class) every score is 0. Repeated rows score alike. Scores depend on
the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_sample, map_texts, slices, texts_of
from ledgerloom.llm.ngrams import codes
from ledgerloom.operators.stored import store

ORDERS, BITS, FEATURES = (3, 4, 5), 20, 20_000
#: A feature must be in so many texts of the sample.
LEAST_TEXTS = 5
ROUNDS, PENALTY = 150, 1e-3
#: Tasks that count the stored sample's features; each has two counters per bucket.
TASKS = 6


@dataclass
class Model:
    #: by bucket, 0 where the feature isn't kept; one more for positions without an n-gram
    weight: np.ndarray
    intercept: float
    learned: bool


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, text_col: str = "text") -> DataFrame:
    """Text and label (0 or 1) of at most about ``per_class`` labelled documents of each class, as a stored table.

    The sample is drawn from the labels, so its side of the join has a known bound and texts stay where they are.
    A document with several labels counts as 1 if any is. Rows that share a labelled id may be many: what the join
    finds is cut to the bound once more.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    sample = bounded_sample(known, "label", per_class, ["doc_id"])
    found = docs.join(F.broadcast(sample), "doc_id").select(F.col(text_col).alias("text"), "label", F.monotonically_increasing_id().alias("row"))
    found = store(found, "labelled")
    # a draw of the bound is a little above or below it by chance; only a table well above is drawn from again
    return bounded_sample(found, "label", per_class + per_class // 5, ["text", "row"]).drop("row")


def present(texts: list[str], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and buckets, each pair once, of the kept buckets that a text has."""
    found = []
    for numbers, begins, buckets in codes(texts, ORDERS, BITS):
        at = np.flatnonzero(kept[buckets])
        owner = numbers[np.searchsorted(begins, at, side="right") - 1]
        found.append(np.unique((owner.astype(np.int64) << (BITS + 1)) | buckets[at]))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> (BITS + 1), pairs & ((1 << (BITS + 1)) - 1)


def all_buckets() -> np.ndarray:
    kept = np.ones((1 << BITS) + 1, dtype=bool)
    kept[-1] = False
    return kept


def fit(sample: DataFrame) -> Model:
    """Learn from ``sample`` (text, label), which is bounded."""
    spark = sample.sparkSession
    empty = Model(np.zeros((1 << BITS) + 1, np.float32), 0.0, False)
    texts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(texts) < 2:
        return empty

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, (1 << BITS) + 1), dtype=np.int32)
        every = all_buckets()
        for batch in batches:
            for part in slices(batch, "text"):
                toxic = part.column("label").to_numpy(zero_copy_only=False)
                owner, bucket = present(texts_of(part, "text"), every)
                for c in (0, 1):
                    seen[c] += np.bincount(bucket[toxic[owner] == c], minlength=seen.shape[1]).astype(np.int32)
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["bucket", "clean", "toxic"])

    counts = (
        sample.coalesce(TASKS).mapInArrow(count, "bucket int, clean int, toxic int")
        .groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= LEAST_TEXTS).toPandas()
    )
    if not len(counts):
        return empty
    q, p = counts["clean"].to_numpy(float), counts["toxic"].to_numpy(float)
    ratio = np.log((p + 1) / (texts[1] + 2)) - np.log((q + 1) / (texts[0] + 2))
    # log-likelihood ratio of presence against the class
    total, base = texts[0] + texts[1], texts[1] / (texts[0] + texts[1])

    def agreement(a: np.ndarray, n: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log(a / np.maximum(n * base, 1e-12)), 0) + np.where(n - a > 0, (n - a) * np.log((n - a) / np.maximum(n * (1 - base), 1e-12)), 0)

    gain = agreement(p, p + q) + agreement(texts[1] - p, total - p - q)
    best = np.sort(np.lexsort((counts["bucket"].to_numpy(), -gain))[:FEATURES])
    buckets, ratio = counts["bucket"].to_numpy()[best], ratio[best]
    place = np.zeros((1 << BITS) + 1, dtype=np.int32)
    place[buckets] = np.arange(1, len(buckets) + 1)
    shared = spark.sparkContext.broadcast(place)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, bucket = present(texts_of(part, "text"), shared.value > 0)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1))
                held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shared.value[bucket] - 1, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("label"), held], names=["label", "features"])

    rows = sample.mapInArrow(encode, "label int, features array<int>").toArrow()
    features = rows.column("features").combine_chunks()
    if isinstance(features, pa.ChunkedArray):
        features = pa.concat_arrays(features.chunks)
    y = rows.column("label").to_numpy().astype(float)
    weight, intercept = regress(features.flatten().to_numpy(), np.diff(features.offsets.to_numpy()), y, ratio)
    out = np.zeros((1 << BITS) + 1, np.float32)
    out[buckets] = weight * ratio
    return Model(out, intercept, True)


def regress(index: np.ndarray, lengths: np.ndarray, y: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 features scaled by ``scale``; both classes weigh the same. Accelerated
    gradient steps, the step from a bound on the curvature found by power iteration."""
    n, m = len(y), len(scale)
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    value = scale.astype(np.float32)[index]
    each = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(n - y.sum(), 1))

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=w[index] * value, minlength=n)

    def back(e: np.ndarray) -> np.ndarray:
        return np.bincount(index, weights=e[row] * value, minlength=m)

    v = np.ones(m) / np.sqrt(m)
    curve = 1.0
    for _ in range(8):
        v = back(each * forward(v))
        curve = np.linalg.norm(v) or 1.0
        v /= curve
    step = 1 / (0.25 * 1.1 * curve + 0.25 + PENALTY)
    w = ahead = np.zeros(m)
    b = ahead_b = 0.0
    for k in range(ROUNDS):
        error = each * (1 / (1 + np.exp(-np.clip(forward(ahead) + ahead_b, -30, 30))) - y)
        new, new_b = ahead - step * (back(error) + PENALTY * ahead), ahead_b - step * error.sum()
        momentum = k / (k + 3)
        ahead, ahead_b = new + momentum * (new - w), new_b + momentum * (new_b - b)
        w, b = new, new_b
    return w, float(b)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1, which replaces a column of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.sparkSession.sparkContext.broadcast(model.weight != 0)

    def judge(texts: list[str]) -> list:
        m = shared.value
        if not m.learned:
            return [np.zeros(len(texts))]
        owner, bucket = present(texts, kept.value)
        total = np.bincount(owner, weights=m.weight[bucket], minlength=len(texts)) + m.intercept
        return [1 / (1 + np.exp(-np.clip(total, -50, 50)))]

    return map_texts(docs, text_col, {"score": "double"}, judge)
