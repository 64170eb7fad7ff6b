"""Increments against a full rebuild, and what they read and replace."""

import random

import pytest
from builders import AS_OF, line, order, shipment

from ledgerloom.operators.dedup import latest_per_key, replace_latest
from ledgerloom.operators.partitions import LOAD
from ledgerloom.plans import intermediate, marts, staging
from ledgerloom.plans.incremental import IncrementalBuild
from ledgerloom.streaming import feed as streaming


def same(got, expected):
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, expected.select(*columns).collect()))


def rebuilt(raw):
    staged = staging.stg_orders(raw)
    fact = marts.fct_orders(intermediate.orders_enriched(staged, staging.stg_line_items(raw), staging.stg_fulfillments(raw)))
    customers = marts.dim_customers(intermediate.customer_history(staged, AS_OF)).drop("updated_at")
    return fact, marts.fct_daily_revenue(fact), customers


def agrees(build, raw):
    fact, daily, customers = rebuilt(raw)
    same(build.fct_orders(), fact)
    same(build.fct_daily_revenue(), daily)
    same(build.dim_customers(AS_OF).drop("updated_at"), customers)


def on(day, **fields):
    return {"created_at": f"{day} 10:00:00", **fields}


FIRST = [
    order("1", 0, customer="a", **on("2024-01-05"), line_items=[line("11"), line("12", quantity="3")]),
    order("2", 0, customer="a", **on("2024-02-05"), total_price="70.0", line_items=[line("21")]),
    order("3", 0, customer="b", **on("2024-02-06"), line_items=[line("31")], fulfillments=[shipment("f3")]),
    order("4", 0, customer=None, **on("2024-03-01")), order("5", 0, customer="c", **on("2024-04-01")),
    order("6", 0, customer="d", **on("2024-04-02"), test="true"), order("7", 0, customer="e", created_at=None),
]


@pytest.fixture
def build(spark, tmp_path):
    return IncrementalBuild(spark, str(tmp_path / "build"), buckets=4)


CHANGED = [order("3", 2, customer="b", **on("2024-02-06"), financial_status="refunded", line_items=[line("31", quantity="9"), line("32")],
                 fulfillments=[shipment("f3", shipment_status="DELIVERED", updated_at="2024-03-01 00:00:00")])]
SECOND = [
    order("0", -5, customer="a", **on("2024-01-01")),  # late, and the first of a known customer
    order("2", -1, customer="a", **on("2024-02-05"), total_price="1.0", line_items=[line("21", quantity="7"), line("22")]),  # an older version
    order("2", 1, customer="c", **on("2024-02-05")),  # goes to another customer
    order("5", 1, customer="c", **on("2024-04-01"), test="true"),  # all of its month turns out to be a test
    order("8", 1, customer=None, **on("2024-01-09")), order("4", 1, customer="a", **on("2024-03-01")),  # guests
    order("7", 1, customer="a", created_at=None),
    order("1", 1, customer="a", **on("2024-01-05"), cancel_reason="CUSTOMER"),
]
THIRD = [order("6", 1, customer="d", **on("2024-04-02"), test="false"), order("0", 3, customer="e", **on("2024-01-01"))]


def test_increments_equal_a_rebuild(build, raw):
    build.land(raw(*FIRST))
    build.run()
    build.land(raw(*CHANGED))
    build.land(raw(*SECOND))  # two loads at once
    build.run()
    agrees(build, raw(*FIRST, *CHANGED, *SECOND))
    build.land(raw(*THIRD))
    build.run()
    agrees(build, raw(*FIRST, *CHANGED, *SECOND, *THIRD))
    assert build.run() == {}


def test_hot_customers_and_random_loads(spark, raw, tmp_path):
    build = IncrementalBuild(spark, str(tmp_path / "hot"), buckets=2, hot_rows=3)
    rng = random.Random(3)
    rows = [
        order(str(i), rng.randrange(9), customer=rng.choice(["a", "b", "c", None]), **on(f"2024-0{1 + i % 4}-0{1 + i % 3}"),
              total_price=f"{rng.randrange(90)}.5", test=rng.choice(["true", "false", None]), line_items=[line(f"{i}1", quantity=str(rng.randrange(9)))])
        for i in (rng.randrange(25) for _ in range(90))]
    # versions of one batch must not differ, or a rebuild has a choice
    rows = list({(r["id"], r["_daton_batch_id"]): r for r in rows}.values())
    for k in range(0, len(rows), 45):
        build.land(raw(*rows[k:k + 45]))
        build.run()
    agrees(build, raw(*rows))


def test_only_touched_months_are_read_and_replaced(build, raw):
    build.land(raw(*FIRST))
    build.run()
    before = set(build.fct_orders().inputFiles())
    build.land(raw(*CHANGED))
    replaced = build.run()
    assert replaced["orders"] == replaced["lines"] == replaced["fct_orders"] == replaced["fct_daily_revenue"] == [202402]
    assert len(replaced["customers"]) == 1
    after = set(build.fct_orders().inputFiles())
    assert {f for f in before if "part_month=202402" not in f} == {f for f in after if "part_month=202402" not in f}
    for read, column in ((build.tables.table("orders", [202402]), "part_month"), (build.arrived(1, 2), LOAD)):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert column in plan.split("PartitionFilters: [")[1].split("]")[0]
    # a new order changes its customer's total in the month of the other one too, and nothing else
    build.land(raw(order("9", 1, customer="b", **on("2024-03-15"))))
    assert build.run()["fct_orders"] == [202402, 202403]


def stopped(*_):
    raise OSError("stopped")


def test_a_run_that_stops_is_taken_up(build, raw, monkeypatch):
    build.land(raw(*FIRST))
    build.run()
    build.land(raw(*SECOND))
    tables = type(build.tables)
    stage, publish = tables.stage, tables.publish
    # nothing is published while one table is still to be staged
    monkeypatch.setattr(tables, "stage", lambda self, load, name, df, parts: stopped() if name == "customers" else stage(self, load, name, df, parts))
    with pytest.raises(OSError):
        build.run()
    assert build.tables.mark() == 1 and build.fct_orders().count() == 6
    # all is staged, and some of it is published
    monkeypatch.setattr(tables, "stage", stage)
    monkeypatch.setattr(tables, "publish", stopped)
    with pytest.raises(OSError):
        build.run()
    monkeypatch.setattr(tables, "publish", publish)
    staged = build.spark.read.parquet(f"{build.tables.root}/pending/{LOAD}=2/tables/fct_orders")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part_month").parquet(f"{build.tables.root}/fct_orders")
    assert build.run() == {} and build.tables.mark() == 2
    agrees(build, raw(*FIRST, *SECOND))


def test_replace_latest_equals_dedup_of_both(raw):
    from pyspark.sql import functions as F

    first = [order(str(i), 0, financial_status="PENDING") for i in range(5)]
    second = [order("1", 2), order("1", 1, financial_status="late"), order("9", 1), order("2", -1, total_price="7")]
    by_key = (["order_id"], staging.order_recency())
    kept = latest_per_key(staging.typed_orders(raw(*first)), *by_key)
    now = replace_latest(kept, staging.typed_orders(raw(*second)), ["order_id"], staging.ORDER_RECENCY)
    same(now, latest_per_key(staging.typed_orders(raw(*first, *second)), *by_key))


def test_many_arrivals_are_shuffled_once_with_the_kept_rows(spark, raw, tmp_path, monkeypatch):
    from ledgerloom.operators import dedup

    monkeypatch.setattr(dedup, "FEW_ARRIVALS", 2, raising=False)
    rng = random.Random(5)
    first = [order(rng.choice("123456"), rng.randrange(4), financial_status=rng.choice(["PENDING", None])) for _ in range(12)]
    second = [order(rng.choice(["1", "3", "8", None]), rng.randrange(9)) for _ in range(12)]
    # versions of one batch must not differ
    first, second = (list({(r["id"], r["_daton_batch_id"]): r for r in rows}.values()) for rows in (first, second))
    spark.createDataFrame(latest_per_key(staging.typed_orders(raw(*first)), ["order_id"], staging.order_recency()).collect(),
                          staging.typed_orders(raw(*first)).schema).write.parquet(str(tmp_path / "kept"))
    kept, came = spark.read.parquet(str(tmp_path / "kept")), staging.typed_orders(raw(*second))
    now = replace_latest(kept, came, ["order_id"], staging.ORDER_RECENCY)
    assert now._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    # of equals, the arrival stays
    both = {r["order_id"]: r for r in kept.collect()}
    for r in sorted(came.collect(), key=lambda r: r["synced_at"]):
        if r["order_id"] not in both or r["synced_at"] >= both[r["order_id"]]["synced_at"]:
            both[r["order_id"]] = r
    assert sorted(map(str, now.collect())) == sorted(map(str, both.values()))


def test_staged_rows_are_dealt_to_their_partitions_when_they_are_published(build, spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 3).alias("part_month"))
    build.tables.begin(1)
    staged = build.tables.stage(1, "lines", rows, [0, 1, 2, 7])
    assert len(staged.inputFiles()) == 4  # as many as tasks made them: nothing was shuffled
    build.tables.commit(1)
    assert build.tables.partitions()["lines"] == [0, 1, 2] and len(build.tables.table("lines").inputFiles()) == 3
    same(build.tables.table("lines"), rows)


def test_a_stream_feeds_the_build_and_a_batch_cut_short_counts_once(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    build = IncrementalBuild(spark, str(tmp_path / "fed"), buckets=4)
    build.land(raw(*FIRST))  # loads from before the stream stay
    build.run()
    raw(*CHANGED).coalesce(1).write.json(folder)
    streaming.follow(spark, folder, build).awaitTermination()
    agrees(build, raw(*FIRST, *CHANGED))
    raw(*SECOND).coalesce(1).write.mode("append").json(folder)
    tables = type(build.tables)
    for stop in ("stage", "publish"):  # before all is staged, and with all staged and nothing published
        with monkeypatch.context() as during:
            during.setattr(tables, stop, stopped)
            with pytest.raises(Exception, match="stopped"):
                streaming.follow(spark, folder, build).awaitTermination()
    assert build.tables.mark() == 2
    # published by another run, before the stream could note that the batch is done
    build.tables.resume()
    assert build.tables.mark() == 3
    before = set(build.fct_orders().inputFiles())
    again = IncrementalBuild(spark, build.tables.root, buckets=4)  # a new driver
    streaming.follow(spark, folder, again).awaitTermination()
    assert set(again.fct_orders().inputFiles()) == before and again.tables.numbers(again.raw, LOAD) == [1, 2, 3]
    agrees(again, raw(*FIRST, *CHANGED, *SECOND))
    raw(*THIRD).coalesce(1).write.mode("append").json(folder)
    streaming.follow(spark, folder, again).awaitTermination()
    assert again.tables.mark() == 4
    agrees(again, raw(*FIRST, *CHANGED, *SECOND, *THIRD))
    with pytest.raises(ValueError, match="stream"):
        again.land(raw(*THIRD))
