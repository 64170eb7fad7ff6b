"""Connected components of an edge table, by hooking to the smallest label around and halving paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.stored import store


def components(edges: DataFrame, a: str = "a", b: str = "b", known: DataFrame | None = None) -> DataFrame:
    """``node`` and ``comp`` (the smallest node it is connected with) of every node with an edge.

    ``known`` are components that the edges are added to: only edges between two of them count, as an edge between
    their smallest nodes. Each round a node takes the smallest label among its own and its neighbours', then the
    label of its label, so that paths halve; a star takes two rounds. Rounds are written to the shared folder, and only
    whether one has changed anything reaches the driver.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    if known is None:
        return _components(pairs)
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    new = ends.join(known, "node", "left_anti").select("node", F.col("node").alias("comp"))
    labels = store(known.unionByName(new), "labels")
    of_a, of_b = (labels.select(F.col("node").alias(x), F.col("comp").alias(f"comp_{x}")) for x in "ab")
    between = pairs.join(of_a, "a").join(of_b, "b").filter("comp_a <> comp_b")
    merged = _components(between.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    merged = merged.select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return store(labels.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), "labels")


def _components(pairs: DataFrame) -> DataFrame:
    both = store(pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))).filter("node <> other").distinct(), "edges")
    labels = store(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("comp")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("other"), F.col("comp").alias("near")), "other")
            .groupBy("node").agg(F.min("near").alias("near"))
        )
        hooked = labels.join(around, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        new = store(hooked.join(up, "comp", "left").select("node", "was", F.least(F.col("comp"), F.coalesce("above", "comp")).alias("comp")), "labels")
        if new.filter("was <> comp").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
