"""Checks as queries for failing rows: a check passes when its DataFrame is empty."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. Two nulls count as a repeated value."""
    return df.groupBy(column).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with a value outside the list; nulls pass."""
    return df.where(~F.col(column).isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key has no parent; null keys pass, null parents change nothing."""
    keys = parent.select(F.col(field).alias("_parent")).distinct()
    rows = child.where(F.col(column).isNotNull())
    return rows.join(keys, rows[column] == keys["_parent"], "left_anti")


def expression(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows where the condition is false; unknown passes."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~test)


def between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside [low, high], either end open when None; nulls pass."""
    value, test = F.col(column), F.lit(True)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return df.where(~test)


def length_between(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(~F.length(column).between(low, high))


def matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(~F.col(column).rlike(pattern))


def without_children(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parents that no child row points to. Repeated child keys go before the shuffle."""
    keys = child.select(F.col(key).alias("_child")).where(F.col("_child").isNotNull()).distinct()
    return parent.join(keys, parent[key] == keys["_child"], "left_anti")


def _two_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two single-row counts on one row, the second as a scalar subquery."""
    return left.select(F.col("n").alias(left_name), right.scalar().alias(right_name))


def _row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_source_lost(source: DataFrame, key: str, target: DataFrame) -> DataFrame:
    """The two counts, if the target's rows are not as many as the source's distinct keys."""
    there = source.agg(F.count_distinct(key).alias("n"))
    counts = _two_counts(there, _row_count(target), "source_count", "target_count")
    return counts.where("source_count <> target_count")


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    return _two_counts(_row_count(a), _row_count(b), "rows_a", "rows_b").where("rows_a <> rows_b")


def fewer_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """The two counts, unless ``a`` has fewer rows than ``b``."""
    return _two_counts(_row_count(a), _row_count(b), "rows_a", "rows_b").where("rows_a >= rows_b")


def _threshold(as_of: dt.datetime | str, part: str, count: int) -> Column:
    return F.timestamp_add(part, F.lit(-count), F.lit(str(as_of)).cast("timestamp"))


def recency(df: DataFrame, column: str, part: str, count: int, as_of: dt.datetime | str) -> DataFrame:
    """The newest time, if it is older than ``count`` parts before ``as_of`` or missing."""
    newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("most_recent"))
    fresh = F.col("most_recent") >= _threshold(as_of, part, count)
    return newest.where(~F.coalesce(fresh, F.lit(False)))


def freshness(
    df: DataFrame, column: Column, as_of: dt.datetime | str, warn_hours: int, error_hours: int
) -> DataFrame:
    """One row: newest load time, its age in hours, and PASS, WARN or ERROR."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    loaded = F.col("max_loaded_at")
    late = lambda hours: ~F.coalesce(loaded >= _threshold(as_of, "HOUR", hours), F.lit(False))
    return newest.select(
        "max_loaded_at",
        F.timestamp_diff("HOUR", loaded, F.lit(str(as_of)).cast("timestamp")).alias("age_hours"),
        F.when(late(error_hours), "ERROR").when(late(warn_hours), "WARN").otherwise("PASS").alias("status"),
    )


def at_least_one(df: DataFrame, column: str) -> DataFrame:
    """One row if the column has no value at all."""
    return df.agg(F.count(column).alias("n_values")).where("n_values = 0")


def row_count_between(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).where(~F.col("n_rows").between(low, high))


def distinct_count_is(df: DataFrame, column: str, expected: int) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_distinct")).where(F.col("n_distinct") != expected)
