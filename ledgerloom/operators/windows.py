"""Per-group window metrics that hold when one group has a large share of all rows.

Spark sorts a window group in one task. That is right for ordinary groups and is what
happens to them here. Groups above a row limit take another way with the same result:

1. range-partition their rows by (group, order), so a group spreads over many chunks;
2. compute every metric inside its chunk, and write that once;
3. summarise each (chunk, group) to one row and carry sums, counts and edge values
   from chunk to chunk. There are at most chunks + groups such rows;
4. join the carried values back and combine.

Which groups are hot is a stored table, not a list on the driver: at a size where most
groups pass the limit it is as long as the data makes it, and it is joined like any
other table. Only the rows of hot groups are written.

The limit is read from ``ledgerloom.hotGroupRows`` in the session.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.stored import store
from ledgerloom.session import shuffle_partitions

HOT_ROWS_SETTING = "ledgerloom.hotGroupRows"
DEFAULT_HOT_ROWS = 2_000_000
#: Cells that keys are screened by, at least and at most.
SCREEN_CELLS = (1 << 10, 1 << 20)


def hot_row_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_SETTING, str(DEFAULT_HOT_ROWS)))


def above_limit(keyed: DataFrame, keys: Sequence[str], total: int, limit: int) -> DataFrame | None:
    """The values of ``keys`` whose ``_rows`` sum to more than ``limit`` as a stored table, None if there are none.

    Keys are screened first. A hash deals them to cells, sums of cells are added up before they are shuffled, and no key
    has more than its cell: where no cell is above the limit, nothing is hot and no key was shuffled. Otherwise only
    the keys of cells above it are counted exactly; such cells are at most ``total / limit``. Beyond some 100,000 limits
    the cells don't grow any more, and more keys come through to the exact count.
    """
    least, most = SCREEN_CELLS
    cells = min(most, max(least, 1 << (8 * total // max(limit, 1)).bit_length()))
    dealt = keyed.withColumn("_cell", F.pmod(F.xxhash64(*keys), F.lit(cells)))
    full = dealt.groupBy("_cell").agg(F.sum("_rows").alias("_sum")).where(F.col("_sum") > limit).select("_cell")
    full = store(full, "cells")
    if full.isEmpty():
        return None
    # a row of eight bytes per cell, at most SCREEN_CELLS of them
    counted = dealt.join(F.broadcast(full), "_cell", "left_semi").groupBy(*keys).agg(F.sum("_rows").alias("_rows"))
    hot = store(counted.where(F.col("_rows") > limit).drop("_rows"), "hot")
    return None if hot.isEmpty() else hot


def hot_groups(
    df: DataFrame, keys: dict[str, Column], weight: Column | None = None, limit: int | None = None
) -> DataFrame | None:
    """The groups with more than ``limit`` rows (or ``weight``) as a stored table, None if there are none.

    ``df`` should be a stored table: this reads the key columns only, and a table that
    is small as a whole is settled by its row count (or the sum of the weights).
    """
    limit = hot_row_limit(df.sparkSession) if limit is None else limit
    one = F.lit(1) if weight is None else weight
    total = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0)).cast("long")).first()[0]
    if total <= limit:
        return None
    keyed = df.select(*[c.alias(n) for n, c in keys.items()], one.cast("long").alias("_rows"))
    return above_limit(keyed, list(keys), total, limit)


def hot_groups_together(
    df: DataFrame, keys: dict[str, Column], limit: int | None = None
) -> dict[str, DataFrame | None]:
    """:func:`hot_groups` for each of several key columns, screened in one pass over the table."""
    limit = hot_row_limit(df.sparkSession) if limit is None else limit
    total = df.count()
    if total <= limit:
        return dict.fromkeys(keys)
    kinds = df.select(*[c.alias(n) for n, c in keys.items()]).schema
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("_of"), c.cast("string").alias("_key")) for n, c in keys.items()]))
    keyed = df.select(each.alias("_each")).select("_each.*", F.lit(1).cast("long").alias("_rows"))
    hot = above_limit(keyed, ["_of", "_key"], total * len(keys), limit)
    # at most the number of keys
    found = set() if hot is None else {r["_of"] for r in hot.select("_of").distinct().collect()}
    return {
        n: hot.where(F.col("_of") == n).select(F.col("_key").cast(kinds[n].dataType).alias(n)) if n in found else None
        for n in keys
    }


@dataclass(frozen=True)
class Metric:
    """One output column. ``kind`` is a method name of :class:`_Plain` and :class:`_Split`."""

    kind: str
    name: str
    column: str | None = None


def row_number(name: str) -> Metric:
    return Metric("row_number", name)


def previous(column: str, name: str) -> Metric:
    return Metric("previous", name, column)


def following(column: str, name: str) -> Metric:
    return Metric("following", name, column)


def running_sum(column: str, name: str) -> Metric:
    return Metric("running_sum", name, column)


def group_count(name: str) -> Metric:
    return Metric("group_count", name)


def group_sum(column: str, name: str) -> Metric:
    return Metric("group_sum", name, column)


def first_value(column: str, name: str) -> Metric:
    return Metric("first_value", name, column)


def last_value(column: str, name: str) -> Metric:
    return Metric("last_value", name, column)


class _Plain:
    """Each metric as an ordinary window expression over ``keys``."""

    def __init__(self, keys: Sequence[str], order: Sequence[Column]):
        self.group = Window.partitionBy(*keys)
        self.ordered = self.group.orderBy(*order)
        self.so_far = self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.whole = self.ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def column(self, metric: Metric) -> Column:
        return getattr(self, metric.kind)(metric.column)

    def row_number(self, _):
        return F.row_number().over(self.ordered).cast("long")

    def previous(self, c):
        return F.lag(c).over(self.ordered)

    def following(self, c):
        return F.lead(c).over(self.ordered)

    def running_sum(self, c):
        return F.sum(c).over(self.so_far)

    def group_count(self, _):
        return F.count("*").over(self.group)

    def group_sum(self, c):
        return F.sum(c).over(self.group)

    def first_value(self, c):
        return F.first_value(c).over(self.whole)

    def last_value(self, c):
        return F.last_value(c).over(self.whole)


def _both(a: Column, b: Column) -> Column:
    """a + b where a null counts as nothing, null when both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _marked(keys: Sequence[str]) -> list[Column]:
    """The keys under other names, for the right side of a join with the same table."""
    return [F.col(k).alias(f"_of_{k}") for k in keys]


def _same(keys: Sequence[str]) -> Column:
    """Equality with the marked keys, a null key being one group like any other."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])


def split_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], metrics: Sequence[Metric],
    chunks: int | None = None,
) -> DataFrame:
    """The metrics for groups too large for one task; ``keys`` may be empty (one global group)."""
    spark = df.sparkSession
    if chunks is None:
        chunks = shuffle_partitions(spark)
    placed = df.repartitionByRange(chunks, *[F.col(k) for k in keys], *order)
    placed = placed.withColumn("_chunk", F.spark_partition_id())

    local = _Plain(["_chunk", *keys], order)
    inside = placed.select(
        "*",
        F.row_number().over(local.ordered).cast("long").alias("_at"),
        *[
            local.column(m).alias(f"_in_{m.name}")
            for m in metrics
            if m.kind in ("previous", "following", "running_sum")
        ],
    )
    inside = store(inside, "split")

    marks = [F.max("_at").alias("_size")]
    for m in metrics:
        if m.kind in ("running_sum", "group_sum"):
            marks.append(F.sum(m.column).alias(f"_sum_{m.name}"))
        elif m.kind in ("previous", "last_value"):
            marks.append(F.max_by(m.column, "_at").alias(f"_edge_{m.name}"))
        elif m.kind in ("following", "first_value"):
            marks.append(F.min_by(m.column, "_at").alias(f"_edge_{m.name}"))
    summary = inside.groupBy("_chunk", *keys).agg(*marks)

    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = [F.col("_size")]
    for m in metrics:
        edge, total = f"_edge_{m.name}", f"_sum_{m.name}"
        out = {
            "row_number": lambda: F.sum("_size").over(before),
            "running_sum": lambda: F.sum(total).over(before),
            "group_count": lambda: F.sum("_size").over(whole),
            "group_sum": lambda: F.sum(total).over(whole),
            "previous": lambda: F.lag(edge).over(along),
            "following": lambda: F.lead(edge).over(along),
            "first_value": lambda: F.first_value(edge).over(whole),
            "last_value": lambda: F.last_value(edge).over(whole),
        }[m.kind]()
        carried.append(out.alias(f"_carry_{m.name}"))
    carry = summary.select(*_marked(["_chunk", *keys]), *carried)

    # at most chunks + number of groups rows
    joined = inside.join(carry, _same(["_chunk", *keys]), "inner")

    columns = [F.col(c) for c in df.columns]
    for m in metrics:
        carry_col, in_col = F.col(f"_carry_{m.name}"), F.col(f"_in_{m.name}")
        value = {
            "row_number": lambda: F.col("_at") + F.coalesce(carry_col, F.lit(0)),
            "running_sum": lambda: _both(carry_col, in_col),
            "previous": lambda: F.when(F.col("_at") == 1, carry_col).otherwise(in_col),
            "following": lambda: F.when(F.col("_at") == F.col("_size"), carry_col).otherwise(in_col),
        }.get(m.kind, lambda: carry_col)()
        columns.append(value.alias(m.name))
    return joined.select(*columns)


def with_group_metrics(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], metrics: Sequence[Metric],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add window metrics per group; the groups in ``hot`` go through :func:`split_window`."""
    plain = _Plain(keys, order)
    if hot is None:
        return df.select("*", *[plain.column(m).alias(m.name) for m in metrics])
    listed = hot.select(*_marked(keys))
    rest = df.join(listed, _same(keys), "left_anti")
    rest = rest.select("*", *[plain.column(m).alias(m.name) for m in metrics])
    large = df.join(listed, _same(keys), "left_semi")
    return rest.unionByName(split_window(large, keys, order, metrics))
