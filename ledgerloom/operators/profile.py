"""Load profiles and raw-against-clean comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_profile(raw: DataFrame) -> DataFrame:
    """Row count and the span of creation times."""
    made = F.col("created_at").cast("timestamp")
    return raw.agg(
        F.count("*").alias("total_rows"),
        F.min(made).alias("first_created_at"),
        F.max(made).alias("last_created_at"),
    )


def _stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rowcounts(sides: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct keys of each named table."""
    return _stacked([
        df.agg(F.count("*").alias("total_rows"), F.count_distinct(key).alias("unique_orders"))
        .select(F.lit(name).alias("table_name"), "total_rows", "unique_orders")
        for name, (df, key) in sides.items()
    ])


def revenue_totals(sides: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The summed amount of each named table."""
    return _stacked([
        df.agg(F.sum(F.col(amount).cast("double")).alias("total_revenue"))
        .select(F.lit(name).alias("source"), "total_revenue")
        for name, (df, amount) in sides.items()
    ])


def dedup_rates(entities: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Raw rows, clean rows and the share removed in percent, per entity.

    ``raw`` sides are one-row aggregates with a column ``raw_rows``.
    """
    parts = []
    for entity, (raw, clean) in entities.items():
        clean_rows = clean.agg(F.count("*").alias("clean_rows"))
        both = raw.select(F.lit(entity).alias("entity"), "raw_rows", clean_rows.scalar().alias("clean_rows"))
        parts.append(both)
    share = 100 * (1 - F.col("clean_rows") / F.col("raw_rows"))
    return _stacked(parts).withColumn("dedup_rate_pct", F.round(share, 2))
