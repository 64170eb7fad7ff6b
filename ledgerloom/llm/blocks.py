"""Large buckets whose nodes aren't all connected: compare in blocks, without a row for each pair."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.operators.stored import store

#: Places that a cluster's nodes are dealt to where they learn its size.
SALTS = 16


def main_comp(rows: DataFrame, of: str) -> DataFrame:
    """The component that most rows of each ``of`` belong to."""
    counts = rows.groupBy(of, "comp").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(of).agg(F.max(F.struct("n", "comp")).alias("top")).select(of, F.col("top.comp").alias("main"))


def clusters(buckets: DataFrame) -> DataFrame:
    """Nodes (node, comp, cluster, outside) of buckets (key, node, comp): buckets that share nodes are a cluster, and
    a node is outside if it isn't in the component that most nodes of its cluster are in."""
    first = buckets.groupBy("key").agg(F.min("node").alias("first"))
    found = components(buckets.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b")).filter("a <> b"))
    placed = buckets.select("node", "comp").distinct().join(found.withColumnRenamed("comp", "cluster"), "node")
    return store(placed.join(main_comp(placed, "cluster"), "cluster").withColumn("outside", F.col("comp") != F.col("main")).drop("main"), "placed")


def in_blocks(placed: DataFrame, size: int, compare: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``compare`` finds between every node outside and every node of its cluster.

    ``placed`` has the columns of :func:`clusters` and whatever ``compare`` needs. It is called for blocks of some
    ``size`` nodes on either side, dealt by hash; a node goes to as many tasks as the other side has blocks.
    """
    counts = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("m"))
    parts = counts.select("cluster", F.ceil(F.col("m") / size).cast("int").alias("rows"), F.ceil(F.col("n") / size).cast("int").alias("columns"))
    # salted, so that a cluster with a large share of all nodes is joined in several places
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    held = salted.join(parts.filter("rows > 0").withColumn("salt", salts), ["cluster", "salt"])

    def own(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    kept = [c for c in placed.columns if c != "outside"]
    left = held.filter("outside").select(*kept, F.lit(True).alias("left"), own("rows").alias("row"), every("columns").alias("column"))
    right = held.select(*kept, F.lit(False).alias("left"), every("rows").alias("row"), own("columns").alias("column"))

    def block(rows: pa.Table) -> pa.Table:
        is_left = rows.column("left").to_numpy()
        return compare(rows.filter(pa.array(is_left)), rows.filter(pa.array(~is_left)))

    # the join above has dealt all of a cluster to one place, which the grouping would keep: deal blocks out
    dealt = left.unionByName(right).repartition("cluster", "row", "column")
    return store(dealt.groupBy("cluster", "row", "column").applyInArrow(block, schema), "blocks")
