"""Exact duplicates by a tree merge of digest runs, in DataFrame operations only.

Every input partition is a run: its rows of one digest become one entry (the row that stays, and a count), and the
entries are kept sorted by digest, in ranges of (run, digest). Runs are then merged in binomial rounds: in each, every
second run goes to its neighbour (with a higher ``fan_in``, all of ``fan_in`` neighbours to the first), the ranges are
dealt out anew, and the neighbours' entries, sorted by digest, are merged in one pass that keeps the best of each. A round
is one range exchange and one sorted merge; n partitions take log2(n) rounds, until one run is left, which lies in ranges
over all tasks. On the way back each entry of the first level learns the final one, so that a row finds its answer by
(run, digest): a group with a third of all rows is met as one entry per run on the way up, and as a run's share on the
way down. Every ``CUT`` rounds the runs are stored, so that a lost executor costs these rounds at most.

An entry is told apart by SHA-256 and, as verification at each level, by the text's length and a second, unlike
digest: texts whose SHA-256 agrees but whose length or second digest differs are never merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import plain
from ledgerloom.operators.stored import store

#: Rows that leave are broadcast up to so many (some 60 bytes each), and joined by a shuffle beyond.
BROADCAST_ROWS = 400_000
#: Rounds between two stored levels.
CUT = 6
#: What must agree for two texts to count as equal.
DIGEST = ["_sha", "_chars", "_second"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, digests, partition and a number of its own for each row; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"), F.unhex(F.sha2(text, 256)).alias("_sha"), F.length(text).alias("_chars"),
        F.xxhash64(text).alias("_second"), F.monotonically_increasing_id().alias("_row"),
        F.spark_partition_id().alias("_run"),
    )


def sorted_runs(entries: DataFrame) -> DataFrame:
    """Entries in ranges of (run, digest), sorted within each; what groups by both needs no other exchange or sort."""
    return entries.repartitionByRange("_run", "_sha").sortWithinPartitions("_run", *DIGEST)


def merge_runs(entries: DataFrame, best: Column, fan_in: int) -> DataFrame:
    """One round: ``fan_in`` neighbouring runs become one, with one entry a digest."""
    met = sorted_runs(entries.withColumn("_run", F.floor(F.col("_run") / fan_in).cast("int")))
    return met.groupBy("_run", *DIGEST).agg(best.alias("_best"), F.sum("_n").alias("_n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 runs: int | None = None, fan_in: int = 2) -> DataFrame:
    """A row per row of ``docs``: id, keep_id (id that stays in its group), group_size, kept, text_sha256.

    ``keep`` names the id that stays, "smallest" or "largest". A null id stays only where a group has no other
    (or, for the smallest, is never preferred). Rows that repeat an id and a text count as copies; one of them is
    kept. Null and empty texts form one group. Other columns aren't read. An empty table gives an empty result.
    ``runs`` puts the partitions together to so many runs before the first round; without it each is a run of its own.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    if fan_in < 2:
        raise ValueError("a round merges two runs at least")
    rows = digests(docs, id_col, text_col)
    rows = store(rows.withColumn("_run", F.col("_run") % runs) if runs else rows, "digests")
    # among rows of the id that stays, the smallest row number
    if keep == "largest":
        whom = F.struct(F.col("_id").alias("id"), (-F.col("_row")).alias("row"))
        best, row = F.max("_best"), -F.col("_final.row")
    else:
        whom = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
        best, row = F.min("_best"), F.col("_final.row")
    # rows of a run meet after a combination in the map tasks
    first = rows.withColumn("_best", whom).groupBy("_run", *DIGEST).agg(best.alias("_best"), F.count(F.lit(1)).alias("_n"))
    first = store(sorted_runs(first), "runs")
    top, left, done = first, (rows.agg(F.max("_run")).first()[0] or 0) + 1, 0
    while left > 1:
        top, left, done = merge_runs(top, best, fan_in), -(-left // fan_in), done + 1
        if done % CUT == 0 and left > 1:
            top = store(top, "merged_runs")
    final = top.select(*DIGEST, F.col("_best").alias("_final"), F.col("_n").alias("_size"))
    back = first.select("_run", *DIGEST).join(final, DIGEST)
    return rows.join(back, ["_run", *DIGEST]).select(
        F.col("_id").alias(id_col), F.col("_final.id").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_row") == row).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    return staying(docs, exact_groups(docs, id_col, text_col, keep), id_col, text_col)


def staying(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``decided`` (id, text_sha256, kept) keeps.

    A decision reaches its row by id and digest. Where rows repeat both, any one of them stays. It is the rows that go
    that are joined, as they are fewer; up to ``BROADCAST_ROWS`` of them the texts stay where they are.
    """
    decided = store(decided.select(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept"), "decided")
    each = decided.groupBy("_id", "_sha").agg(F.count(F.lit(1)).alias("_rows"), F.max("kept").alias("_some"))
    leaving = store(each.filter("_rows > 1 OR NOT _some"), "leaving")
    again = leaving.filter("_rows > 1 AND _some").select("_id", "_sha")
    leaving = leaving.select("_id", "_sha")
    if leaving.count() <= BROADCAST_ROWS:
        leaving = F.broadcast(leaving)
    names, held = docs.columns, plain(docs)
    id_of, text_of = F.col(held.columns[names.index(id_col)]), F.col(held.columns[names.index(text_col)])
    keyed = held.withColumns({"_of_id": id_of, "_of_sha": F.unhex(F.sha2(F.coalesce(text_of, F.lit("")), 256))})
    same = F.col("_of_id").eqNullSafe(F.col("_id")) & (F.col("_of_sha") == F.col("_sha"))
    once = keyed.join(leaving, same, "left_anti").select(*held.columns)
    if again.isEmpty():
        return once.toDF(*names)
    row = F.first(F.struct(*held.columns)).alias("_row")
    one = keyed.join(again, same, "left_semi").groupBy("_of_id", "_of_sha").agg(row).select("_row.*")
    return once.unionByName(one).toDF(*names)
