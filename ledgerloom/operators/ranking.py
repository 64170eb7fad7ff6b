"""Ranks over a whole table, without moving it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.windows import group_count, group_sum, row_number, running_sum, split_window


def _places(df: DataFrame, by: str, descending: bool) -> DataFrame:
    """Per distinct value: ``_above`` rows that sort strictly before it, and ``_rows`` in all.

    Counts per value are summed in order, so rows that tie are never gathered: a value
    shared by a third of the table is one counted row.
    """
    counts = df.groupBy(by).agg(F.count("*").alias("_ties"))
    order = F.col(by).desc() if descending else F.col(by).asc()
    summed = split_window(
        counts, [], [order], [running_sum("_ties", "_upto"), group_sum("_ties", "_rows")]
    )
    return summed.select(
        F.col(by).alias("_by"), (F.col("_upto") - F.col("_ties")).alias("_above"), "_rows"
    )


def _beside(df: DataFrame, by: str, places: DataFrame, value: Column, name: str) -> DataFrame:
    """Join a value's place to its rows; an equality join that AQE may split at a hot value."""
    named = places.select("_by", value.alias(name))
    return df.join(named, df[by].eqNullSafe(named["_by"]), "inner").drop("_by")


def with_ranks(df: DataFrame, ranks: dict[str, str], descending: bool = True) -> DataFrame:
    """RANK() over the whole table per (name, column): equal values share a rank and leave a gap.

    Pass a stored table: it is read once per rank, and all readings must see the same numbers.
    """
    ranked = df
    for name, by in ranks.items():
        ranked = _beside(ranked, by, _places(df, by, descending), F.col("_above") + 1, name)
    return ranked


def with_percent_rank(df: DataFrame, by: str, name: str, descending: bool = False) -> DataFrame:
    """PERCENT_RANK() over the whole table: (rank - 1) / (rows - 1), 0 for a single row."""
    share = F.when(F.col("_rows") > 1, F.col("_above") / (F.col("_rows") - 1)).otherwise(0.0)
    return _beside(df, by, _places(df, by, descending), share, name)


def with_position(df: DataFrame, order: list[Column], position: str, total: str) -> DataFrame:
    """ROW_NUMBER() and COUNT(*) over the whole table in the given order."""
    return split_window(df, [], order, [row_number(position), group_count(total)])


def with_ntile(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """NTILE over the whole table: the first ``rows % tiles`` tiles hold one row more."""
    placed = with_position(df, order, "_position", "_rows")
    at, size, extra = F.col("_position"), F.floor(F.col("_rows") / tiles), F.col("_rows") % tiles
    in_larger = extra * (size + 1)
    tile = F.when(at <= in_larger, F.ceil(at / (size + 1))).otherwise(
        extra + F.ceil((at - in_larger) / F.greatest(size, F.lit(1)))
    )
    return placed.select(*df.columns, tile.cast("long").alias(name))
