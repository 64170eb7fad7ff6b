"""The registered queries of this package and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat, exact_dedup, langid, mixing, near_dedup, packing, passages, pieces, prefix_trie, quality
from ledgerloom.llm import runs, token_counts, toxicity
from ledgerloom.llm.common import WORD, fold, table, word_count
from ledgerloom.operators.windows import hot_groups, row_number, with_group_metrics

#: Vocabulary files of public tokenizers; any file that the library reads may be given to the operators.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
UNIGRAM_PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents; the largest id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


SQL["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; what crc32 of the id puts in fold 0 of 5 is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold(F.col("doc_id"), 5) == 0).alias("held_out"))
    model = langid.fit(docs.filter("NOT held_out"), key=["doc_id"])
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return piece_digests(packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], rows.schema))
    made = chat.format_conversations(rows)
    turns = made.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("trained", F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss")), ""))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL["op8_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), opened AS (
    SELECT *, coalesce(lag(role) OVER in_order <> role, true) AS opens,
           row_number() OVER in_order AS place
    FROM turns WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(length('<turn></turn>') + length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')))
        + sum(length('### ') + 1 + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'))) FILTER (WHERE opens)
        + count(*) FILTER (WHERE opens) - 1)::BIGINT AS formatted_chars
FROM opened GROUP BY conv_id
"""


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that their sources weigh 1, 2, 3, repeating."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, word_count(F.col("text")), F.array("source"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


#: Labelled documents that a classifier learns from, of each class at most about so many.
LABELLED_PER_CLASS = 5000


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of what crc32 of the id puts in fold 1 of 3 aren't learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, "toxic", LABELLED_PER_CLASS))
    held = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    scored = toxicity.score(held, model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base limits and the trees' verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", LABELLED_PER_CLASS)
    return quality.judge(docs, quality.fit(sample)).drop("text")


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by the pieces and scores of a public vocabulary taken as a unigram model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_count(docs, UNIGRAM_PIECES).drop("text")


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates among all documents; the smallest id names a class."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("text_sha256")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that documents share, and the classes that they connect."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces by a public BPE model, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, UNIGRAM_PIECES, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by a hash of its id, with words that go on periodically from some place."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))

    def planted(words):
        n = F.size(words)
        a = (F.col("g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")

    # an array of one, so that the words of a text are found once
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    changed = F.transform(F.filter(words, lambda w: F.size(w) > 0), planted)
    return docs.select("doc_id", F.when(F.col("h") % 10 == 0, F.get(changed, F.lit(0))).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without their repeats."""
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    found = runs.with_runs(docs).drop("text")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def shared_turns(conv):
    """How many first turns a conversation takes from that whose id is the next lower multiple of five."""
    return F.crc32(conv.cast("string").cast("binary")) % 9


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """The turns of all conversations after each has taken its first ones from another; ``place`` orders them."""
    turns = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = with_group_metrics(turns, ["conv_id"], order, [row_number("place")], hot_groups(turns, {"conv_id": F.col("conv_id")}))
    own = F.when(F.col("place") > shared_turns(F.col("conv_id")), F.array("conv_id")).otherwise(F.array().cast("array<long>"))
    given = F.when(
        (F.pmod("conv_id", F.lit(5)) == 0) & (F.col("place") < 9),
        F.filter(F.sequence("conv_id", F.col("conv_id") + 4), lambda c: F.col("place") <= shared_turns(c))).otherwise(F.array().cast("array<long>"))
    dealt = placed.select(F.explode(F.concat(own, given)).alias("conv_id"), "place", "role", "text")
    return dealt.join(turns.select("conv_id").distinct(), "conv_id", "left_semi")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the conversations' prefixes, once neighbours share their first turns."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(rebuilt_conversations(turns), turns.select("conv_id"), order=["place"])
