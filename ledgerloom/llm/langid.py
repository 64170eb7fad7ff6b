"""Language identification: multinomial naive Bayes over hashed character n-grams.

The counts come from a bounded sample of labelled texts (``per_language`` of each language); the matrix of log
probabilities, languages x buckets, is broadcast, and texts are scored in batches: the rows of the matrix that a
text's n-grams point to are summed.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text where there is
nothing to learn from. Equal totals go to the first language by name. Repeated rows are scored alike. Labels that are
null are not learned from. Only the text decides a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_sample, in_batches, map_texts, plain, slices, texts_of
from ledgerloom.llm.ngrams import codes
from ledgerloom.operators.stored import store

ORDERS, BITS, SMOOTHING = (1, 2, 3), 16, 0.5
UNDETERMINED = "und"
#: Languages that are learned, the most frequent ones of the labels.
LANGUAGES = 128
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    languages: list[str]
    #: buckets + 1 rows (the last for positions without an n-gram) by languages
    log_p: np.ndarray
    prior: np.ndarray


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 4000,
        key: list[str] | None = None) -> Model:
    """Learn from at most about ``per_language`` texts of each language, whole texts each, of the ``LANGUAGES`` most
    frequent languages."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), *[F.col(c).alias(f"_{c}") for c in key or []])
    sample = bounded_sample(rows, "lang", per_language, [f"_{c}" for c in key or []] + ["text"], LANGUAGES).select("lang", "text")
    # read with all tasks, then counted by few of them, as each holds a table per language
    sample = store(sample.withColumn("row", F.monotonically_increasing_id()), "language-sample")
    # rows that repeat id and text share a draw and may be many: cut once more, as a draw is only about the bound
    sample = bounded_sample(sample, "lang", per_language + per_language // 5, ["text", "row"], LANGUAGES).drop("row")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                by: dict[str, list[str]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), texts_of(part, "text"), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, own in by.items():
                    total = seen.setdefault(lang, np.zeros((1 << BITS) + 1, dtype=np.int64))
                    texts[lang] = texts.get(lang, 0) + len(own)
                    for _, _, found in codes(own, ORDERS, BITS):
                        total += np.bincount(found, minlength=len(total))
        for lang, total in seen.items():
            total[-1] = texts[lang]
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"])

    counts = (
        in_batches(sample.coalesce(8), count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(counts["lang"].unique())
    table = np.zeros(((1 << BITS) + 1, len(languages)))
    table[counts["bucket"].to_numpy(int), counts["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(int)] = counts["n"]
    texts = table[-1].copy()
    log_p = np.log(table + SMOOTHING) - np.log(table[:-1].sum(0) + SMOOTHING * (1 << BITS))
    log_p[-1] = 0
    return Model(languages, log_p.astype(np.float32), np.log(texts / max(texts.sum(), 1)) if languages else texts)


def totals(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Sum of the matrix rows that each text's n-grams point to."""
    out = np.zeros((len(texts), matrix.shape[1]))
    columns = np.ascontiguousarray(matrix.T)
    for numbers, begins, found in codes(texts, ORDERS, BITS):
        for k, column in enumerate(columns):
            np.add.at(out[:, k], numbers, np.add.reduceat(column[found], begins, dtype=np.float64))
    return out


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability of that language; these two replace
    columns of their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: list[str]) -> list:
        m = shared.value
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if LETTER.search(t)] if m.languages else []
        if at:
            joint = totals([texts[i] for i in at], m.log_p) + m.prior
            scores[at] = 1 / np.exp(joint - joint.max(1, keepdims=True)).sum(1)
            for i, k in zip(at, joint.argmax(1), strict=True):
                langs[i] = m.languages[k]
        return [langs, scores]

    return map_texts(docs, text_col, {"lang_pred": "string", "score": "double"}, predict)


def reject(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language can't be told: ``und``, or a score below ``least``. All columns stay."""
    held = plain(docs)
    told = identify(held, model, held.columns[docs.columns.index(text_col)])
    return told.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*held.columns).toDF(*docs.columns)
