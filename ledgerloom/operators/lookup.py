"""Joins of large tables with small lookup tables, and list filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUP_ROWS = 1_000
LOOKUP_BYTES = 64 << 20


def _width(field: T.StructField) -> Column:
    """About how many bytes a value takes."""
    value = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(value)))
    return F.lit(16)


def broadcast_if_small(lookup: DataFrame, rows: int = LOOKUP_ROWS, size: int = LOOKUP_BYTES) -> DataFrame:
    """Hint a broadcast for a lookup of at most ``rows`` rows and ``size`` bytes; leave a larger one to a shuffle join."""
    width = reduce(lambda a, b: a + b, map(_width, lookup.schema.fields), F.lit(0))
    found = lookup.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()
    return F.broadcast(lookup) if found["n"] <= rows and found["bytes"] <= size else lookup


def map_values(
    df: DataFrame, lookup: DataFrame, on: tuple[Column, Column], add: dict[str, Column]
) -> DataFrame:
    """LEFT join on equality and add the given expressions over both sides."""
    side = broadcast_if_small(lookup)
    joined = df.join(side, on[0] == on[1], "left")
    return joined.select(*[df[c] for c in df.columns if c not in add], *[c.alias(n) for n, c in add.items()])


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """``column NOT IN (list)`` with SQL's null rules, as a plain anti join.

    A null in the list rejects every row, an empty list rejects none, and a null column
    is rejected unless the list is empty. Written out, this stays an equality join for
    a list of any size; Spark's own null-aware form falls back to a nested loop when
    the list is too large to broadcast.
    """
    values = listed.select(F.col(listed_column).alias("_listed"))
    facts = values.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col("_listed").isNull()).alias("nulls")).alias("f")
    ).scalar()
    known = values.where(F.col("_listed").isNotNull()).distinct()
    kept = df.join(known, df[column] == known["_listed"], "left_anti")
    passes = (facts["nulls"] == 0) & F.col(column).isNotNull()
    return kept.where((facts["n"] == 0) | passes)


# Texts are cut into pieces of at most this length; it bounds the pieces of a text to this times its length.
ANCHOR = 4


def _pieces(text: Column, n: int) -> Column:
    """All substrings of length ``n``."""
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    pieces = F.transform(starts, lambda at: F.substring(text, at, F.lit(n)))
    return F.when(F.length(text) >= n, pieces).otherwise(F.array().cast("array<string>"))


def _anchor(word: Column) -> Column:
    """The beginning of the longest stretch of a LIKE pattern without wildcard or escape."""
    literal = F.split(word, r"\\.|[%_]")
    longest = F.reduce(literal, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return F.substring(longest, 1, ANCHOR)


def contains_keyword(df: DataFrame, text: str, lookup: DataFrame, keyword: str) -> DataFrame:
    """LEFT join where the text contains the keyword, whatever the case.

    A text with several keywords gives a row for each; one with none keeps a row of
    nulls. In LIKE, ``%`` and ``_`` in a keyword are wildcards. Each keyword has an
    anchor, up to ``ANCHOR`` characters that a text must hold literally; every distinct
    text is cut into pieces as long as anchors are, which makes the candidates an equality
    join, and LIKE decides among those alone. A keyword of nothing but wildcards fits
    nearly every text, and is met by each.
    """
    words = lookup.withColumn("_word", F.lower(F.col(keyword))).withColumn("_anchor", _anchor(F.col("_word")))
    # at most ANCHOR + 1 different lengths
    lengths = [r[0] for r in words.select(F.length("_anchor")).distinct().collect() if r[0] is not None]
    texts = df.select(F.col(text).alias("_text")).where(F.col(text).isNotNull()).distinct()
    low = F.lower("_text")
    # the empty piece stands once for each text, the others where they occur
    cuts = [F.array(F.lit("")) if n == 0 else _pieces(low, n) for n in lengths] or [F.array().cast("array<string>")]
    pieces = texts.select("_text", F.explode(F.array_distinct(F.concat(*cuts))).alias("_anchor"))
    fits = F.like(low, F.concat(F.lit("%"), F.col("_word"), F.lit("%")))
    matches = pieces.join(broadcast_if_small(words), "_anchor", "inner").where(fits).drop("_anchor", "_word")
    return df.join(matches, df[text] == matches["_text"], "left").drop("_text")
