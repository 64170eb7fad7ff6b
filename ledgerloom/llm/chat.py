"""Conversations as training text, and back, in Spark expressions only.

The template::

    ### user
    <turn>Hello</turn>
    ### assistant
    <turn>Hi.</turn><turn>How can I help?</turn>

A block holds neighbouring turns of one role, merged under one heading; every turn keeps its own marks. Roles and texts
are escaped so that neither ``<`` nor ``#`` stands in them: a backslash is written ``\\b``, ``<`` as ``\\l`` and ``#`` as
``\\h``. So headings and marks can't come from a text, and unescaping gives the text back exactly.

Loss spans, in code points of the formatted text, cover the texts of the trained role, without their marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADING, OPEN, CLOSE = "### ", "<turn>", "</turn>"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit("#"), F.lit("\\h"))


def unescaped(text: Column) -> Column:
    """Every backslash opens a pair, so the pairs may be put back one kind at a time, the backslash last."""
    out = F.replace(text, F.lit("\\h"), F.lit("#"))
    out = F.replace(out, F.lit("\\l"), F.lit("<"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame, trained: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per conversation: its id, ``formatted``, and ``loss`` as an array of (begin, length) in code points.

    Turns are ordered by turn number, null first; rows that share it by role, then text, and repeated rows are turns
    of their own. A null role or text counts as empty. Rows with a null id form a conversation of their own. Other
    columns aren't read. A conversation is gathered in one row, as its text is one value. An empty table gives an
    empty result.
    """
    rows = turns.select(
        F.col(conv_col).alias("_conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("_turn"),
    )
    sorted_turns = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    # a turn opens a block where the role before it is another
    opened = sorted_turns.withColumn("_turns", F.transform("_turns", lambda t, i: F.struct(
        t["role"].alias("role"), escaped(t["text"]).alias("text"),
        ((i == 0) | (F.get(F.col("_turns"), i - 1)["role"] != t["role"])).alias("opens"))))
    block = F.struct(F.lit("").alias("role"), F.array().cast("array<string>").alias("texts"))

    def add(blocks: Column, t: Column) -> Column:
        own = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        last = F.element_at(blocks, -1)
        merged = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(t["text"])).alias("texts"))
        return F.when(t["opens"], F.concat(blocks, F.array(own))).otherwise(
            F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(merged)))

    blocks = opened.withColumn("_blocks", F.aggregate(
        "_turns", F.filter(F.array(block), lambda b: F.lit(False)), add))
    heads = blocks.withColumn("_blocks", F.transform("_blocks", lambda b, i: F.struct(
        b["role"].alias("role"), b["texts"].alias("texts"),
        F.concat(F.when(i > 0, F.lit("\n")).otherwise(F.lit("")), F.lit(HEADING), escaped(b["role"]), F.lit("\n")).alias("head"))))
    formatted = F.array_join(F.transform("_blocks", lambda b: F.concat(
        b["head"], F.lit(OPEN), F.array_join(b["texts"], CLOSE + OPEN), F.lit(CLOSE))), "")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,length:bigint>>").alias("spans"))

    def spans_of(state: Column, b: Column) -> Column:
        inner = F.aggregate(b["texts"], F.struct((state["at"] + F.length(b["head"])).cast("long").alias("at"), state["spans"].alias("spans")), lambda s, text: F.struct(
            (s["at"] + len(OPEN) + F.length(text) + len(CLOSE)).cast("long").alias("at"),
            F.when(b["role"] == trained, F.concat(s["spans"], F.array(F.struct(
                (s["at"] + len(OPEN)).cast("long").alias("begin"), F.length(text).cast("long").alias("length"))))).otherwise(s["spans"]).alias("spans")))
        return inner

    return heads.select(
        F.col("_conv").alias(conv_col), formatted.alias("formatted"), F.aggregate("_blocks", begin, spans_of)["spans"].alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    blocks = F.slice(F.split(formatted, HEADING), 2, F.greatest(F.size(F.split(formatted, HEADING)) - 1, F.lit(0)))
    return F.flatten(F.transform(blocks, _turns_of))


def _turns_of(block: Column) -> Column:
    role = unescaped(F.regexp_replace(F.substring_index(block, OPEN, 1), r"\n\z", ""))
    marked = F.split(block, OPEN)
    texts = F.slice(marked, 2, F.size(marked) - 1)
    return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(F.substring_index(t, CLOSE, 1)).alias("text")))


def loss_texts(formatted: Column, loss: Column) -> Column:
    """What the loss spans cover, unescaped, span by span."""
    return F.transform(loss, lambda s: unescaped(F.substr(formatted, (s["begin"] + 1).cast("int"), s["length"].cast("int"))))
