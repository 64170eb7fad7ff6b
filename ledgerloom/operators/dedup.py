"""Row deduplication: the latest version per key, and the alternatives to it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.windows import row_number, with_group_metrics


def rank_versions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, hot: DataFrame | None = None
) -> DataFrame:
    """Number the versions of every key, 1 being the one to keep; all rows stay.

    ``hot`` has the keys with more versions than one task should sort.
    """
    return with_group_metrics(df, keys, order, [row_number(name)], hot)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key by ``order``.

    Catalyst turns the ``= 1`` filter into a window group limit that runs before the
    shuffle as well: each map task sends at most one row per key, so a key that holds
    a large share of the rows costs one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_version", place).where("_version = 1").drop("_version")


def upsert_latest(
    kept: DataFrame, arrived: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Fold newly arrived versions into a table that has the latest row per key.

    Only keys that arrive again are compared; the rows of all others pass through.
    """
    came = arrived.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    touched = kept.join(came, same, "left_semi").unionByName(arrived)
    return kept.join(came, same, "left_anti").unionByName(latest_per_key(touched, keys, order))


#: Up to so many arriving rows are joined with the kept ones, which Spark can broadcast.
FEW_ARRIVALS = 100_000


def replace_latest(kept: DataFrame, arrived: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """Fold arrivals into a table that has the latest row per key; the greatest ``recency`` wins, an arrival if equal.

    A few arrivals are joined with the kept rows, of which none is shuffled where Spark broadcasts the arrivals. More of
    them are deduplicated together with the kept rows, in one shuffle of both. A null key is a key like any other.
    """
    order = [F.col(c).desc() for c in recency]
    if arrived.limit(FEW_ARRIVALS + 1).count() > FEW_ARRIVALS:
        came = arrived.select(*kept.columns, F.lit(True).alias("_came"))
        both = kept.select("*", F.lit(False).alias("_came")).unionByName(came)
        return latest_per_key(both, keys, [*order, F.col("_came").desc()]).drop("_came")
    newest = latest_per_key(arrived, keys, order)
    marked = [F.col(k).alias(f"_new_{k}") for k in keys]
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    joined = kept.join(newest.select(F.struct(*kept.columns).alias("_came"), *marked), same, "left")
    # structs compare field by field, null being the smallest
    later = F.struct(*[F.col(f"_came.{c}") for c in recency]) >= F.struct(*recency)
    row = F.when(F.col("_came").isNotNull() & later, F.col("_came")).otherwise(F.struct(*kept.columns))
    fresh = newest.join(kept.select(*marked), same, "left_anti")
    return joined.select(row.alias("_row")).select("_row.*").unionByName(fresh.select(*kept.columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicates only."""
    return df.distinct()


def greatest_per_column(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """One row per key with the greatest value of every column, which may mix versions."""
    return df.groupBy(key).agg(*[F.max(c).alias(a) for c, a in columns.items()])


def join_to_latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows whose version equals the key's greatest version; ties all stay."""
    newest = df.groupBy(key).agg(F.max(version).alias(version))
    return df.join(newest, [key, version], "inner")


def duplicate_counts(df: DataFrame, key: str, name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def rows_of_duplicates(df: DataFrame, key: str) -> DataFrame:
    """All rows of the keys that occur more than once."""
    return df.join(duplicate_counts(df, key), key, "left_semi")


def sync_history(raw: DataFrame, top: int | None = None) -> DataFrame:
    """How often and when each re-delivered order was synced, most often first; ``top`` limits it to so many."""
    history = (
        raw.groupBy(F.col("id").alias("order_id"))
        .agg(
            F.count("*").alias("times_synced"),
            F.min(F.col("_daton_batch_runtime").cast("long")).alias("first_sync"),
            F.max(F.col("_daton_batch_runtime").cast("long")).alias("last_sync"),
        )
        .where("times_synced > 1")
    )
    ordered = history.orderBy(F.col("times_synced").desc(), F.col("order_id").asc())
    return ordered if top is None else ordered.limit(top)
