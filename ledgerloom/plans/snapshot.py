"""The states of orders kept as a table, which each load of versions is merged into.

Three tables lie in one folder. ``open`` has the current state of every order, by buckets of orders; ``closed`` has the
states that have ended and ``seen`` the versions that have come, both by the load that brought them. A merge

* reads the open rows of the arriving orders alone, extends them by the new versions, and appends what this closes as the
  load's own partition; no closed row is read;
* takes an order whose versions come late, that is not after the last one seen, through all its versions again, and
  takes its old rows out of the partitions that hold any.

So the cost is that of the load, and of the history of those orders that were late. A load that is merged again changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import windows as win
from ledgerloom.operators.partitions import PartitionedTables, bucket_of, keyed_join
from ledgerloom.operators.stored import store
from ledgerloom.plans.changes import ORDER_OF_VERSIONS, TRACKED, state_spans, typed_states

BUCKET, LOAD = "part_bucket", "part_load"
TABLES = {"open": BUCKET, "closed": LOAD, "seen": LOAD}


class OrderSnapshot:
    """Orders' states over time. With ``history=False`` a state that ends is overwritten and only the newest is kept."""

    def __init__(self, spark: SparkSession, root: str, tracked: tuple[str, ...] = TRACKED, buckets: int = 64,
                 history: bool = True, hot_rows: int | None = None):
        self.spark, self.tracked, self.buckets, self.history, self.hot_rows = spark, tracked, buckets, history, hot_rows
        self.tables = PartitionedTables(spark, root, TABLES)

    def rows(self) -> DataFrame:
        """Order, tracked columns, when they held, and whether they do now."""
        current = self.tables.table("open").withColumn("valid_to", F.lit(None).cast("timestamp"))
        parts = [current, self.tables.table("closed")] if self.history else [current]
        spans = [
            p.select("order_id", "_state.*", F.col("synced_at").alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))
            for p in parts]
        return spans[0] if len(spans) == 1 else spans[0].unionByName(spans[1])

    def merge(self, raw: DataFrame, load: int | None = None) -> int:
        """Take in the versions of one delivery as the next load; says its number. One up to the mark is in already."""
        self.tables.resume()
        load = load or self.tables.mark() + 1
        if load <= self.tables.mark():
            return load
        self.tables.begin(load)
        came = store(typed_states(raw, self.tracked), "versions")
        last = F.max(F.struct(*ORDER_OF_VERSIONS))
        orders = store(came.groupBy("order_id").agg(
            F.min(F.struct(*ORDER_OF_VERSIONS, "_state")).alias("_first"), last.alias("_last"),
        ).withColumn(BUCKET, bucket_of("order_id", self.buckets)), "orders")
        buckets = [r[0] for r in orders.select(BUCKET).distinct().collect()]  # at most the number of buckets

        # an open row: the version that opened the state, and the last one seen
        like = came.select(*came.columns, F.struct(*ORDER_OF_VERSIONS).alias("last"), F.lit(0).alias(BUCKET))
        kept = self.tables.kept("open", like, buckets)
        known = keyed_join(orders, kept.select("order_id", F.col("last").alias("_seen"), F.col("_state").alias("_open")), "order_id", "left")
        seen, first = F.col("_seen"), F.struct(*[f"_first.{c}" for c in ORDER_OF_VERSIONS])
        late = (first < seen) | ((first == seen) & (F.col("_first._state") != F.col("_open")))
        known = store(known.withColumn("_late", F.coalesce(late, F.lit(False))), "known")
        on_time = known.where(~F.col("_late")).select("order_id")
        late = known.where("_late").select("order_id")
        others = keyed_join(kept, orders.select("order_id"), "order_id", "left_anti")

        if not self.history:  # the newest of the open row and the arrivals, whenever they came
            newest = came.groupBy("order_id").agg(F.max_by(F.struct(*came.columns), F.struct(*ORDER_OF_VERSIONS)).alias("_row")).select("_row.*")
            newest = newest.withColumn("last", F.struct(*ORDER_OF_VERSIONS)).withColumn(BUCKET, bucket_of("order_id", self.buckets))
            mine = kept.select("order_id", F.struct(*kept.columns).alias("_kept"))
            both = keyed_join(newest.select("order_id", F.struct(*kept.columns).alias("_new")), mine, "order_id", "left")
            row = F.when(F.col("_kept.last") > F.col("_new.last"), F.col("_kept")).otherwise(F.col("_new"))
            self.tables.stage(load, "open", others.unionByName(both.select(row.alias("_row")).select("_row.*")), buckets)
            self.tables.commit(load)
            return load

        hot = win.hot_groups(came, {"order_id": F.col("order_id")}, limit=self.hot_rows)
        # on time: the open state is the first of the versions; what came before it is closed already
        opened = keyed_join(kept.select(*came.columns), on_time, "order_id", "left_semi")
        spans = state_spans(opened.unionByName(keyed_join(came, on_time, "order_id", "left_semi")), hot)
        closed_parts, any_late = [load], not late.isEmpty()
        if any_late:
            log = keyed_join(self.tables.kept("seen", came), late, "order_id", "left_semi").unionByName(keyed_join(came, late, "order_id", "left_semi"))
            log = store(log, "late")
            spans = spans.unionByName(state_spans(log, win.hot_groups(log, {"order_id": F.col("order_id")}, limit=self.hot_rows)))
        spans = store(spans, "spans")
        ended = spans.where(F.col("valid_to").isNotNull()).withColumn(LOAD, F.lit(load))
        if any_late:
            before = self.tables.kept("closed", ended)
            held = keyed_join(before.select("order_id", LOAD), late, "order_id", "left_semi").select(LOAD).distinct()
            closed_parts = sorted({load, *(r[0] for r in held.collect())})  # loads
            rest = keyed_join(self.tables.kept("closed", ended, closed_parts), late, "order_id", "left_anti")
            ended = rest.where(F.col(LOAD) != load).unionByName(ended)
        self.tables.stage(load, "closed", ended, closed_parts)

        seen_last = known.select("order_id", F.greatest("_last", "_seen").alias("last"), BUCKET)
        now = keyed_join(spans.where("valid_to IS NULL").drop("valid_to"), seen_last, "order_id", "inner")
        self.tables.stage(load, "open", others.unionByName(now), buckets)
        self.tables.stage(load, "seen", came.withColumn(LOAD, F.lit(load)), [load])
        self.tables.commit(load)
        return load
