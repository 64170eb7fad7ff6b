"""A training corpus from ``documents``, stage by stage: each one is written, read again and given to the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, langid, mixing, near_dedup, packing
from ledgerloom.llm.common import word_count
from ledgerloom.llm.queries import WORD_TOKENIZER, piece_digests
from ledgerloom.operators.stored import store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by a model of the labelled ones."""
    return langid.reject(docs, langid.fit(docs, key=["doc_id"]))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs, word_count(F.col("text")), F.array("source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens."""
    return piece_digests(packing.pack(docs, WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix", mix), ("pack", pack),
]

#: SQL has neither the language model, near duplicates, the mix nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
