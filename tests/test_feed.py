import datetime as dt
import glob

import pytest

from ledgerloom import session
from ledgerloom.catalog import queries
from ledgerloom.catalog.feed_models import FeedModels
from ledgerloom.operators import windows
from ledgerloom.operators.stored import store
from ledgerloom.sources import feed

DAY = dt.datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders with repeated lines, without lines; lines without a part or an order."""
    root = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, k * 10, "F", 1000.0 * k, DAY) for k in range(1, 6)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{root}/orders.parquet")
    part = [(p, f"name {p}", "brand", "type", p, 9.5) for p in (1, 2)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{root}/part.parquet")
    lines = [
        (1, 1, 7, 1, "A", "F", 1), (1, 2, 7, 2, "N", "F", 2), (1, 1, 8, 1, "R", "F", 3),  # line 1 twice
        (2, 9, 7, 1, "A", "F", 1),  # no such part
        (3, 1, 7, 1, "A", "O", 1),  # not sent
        (3, None, 7, 2, "A", "F", 1), (77, 1, 7, 1, "A", "F", 1), (None, 1, 7, 1, "A", "F", 1),
    ]
    rows = [(o, p, s, n, 2.0, 10.0, 0.1, 0.0, rf, ls, DAY + dt.timedelta(days=d)) for o, p, s, n, rf, ls, d in lines]
    spark.createDataFrame(
        rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,"
        " l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{root}/lineitem.parquet")
    return root


def nested(raw):
    return sorted(
        (r["id"], r["_daton_batch_id"], r["financial_status"], [x["id"] for x in r["line_items"]],
         None if r["fulfillments"] is None else [(x["id"], x["shipment_status"]) for x in r["fulfillments"]])
        for r in raw.collect())


EXPECTED = [
    ("1", "b0", "PENDING", ["11", "12"], [("10007", "DELIVERED")]),
    ("1", "b1", "Paid", ["11"], [("10008", "confirmed")]),
    ("2", "b0", "Paid", [], [("20007", "DELIVERED")]),
    ("3", "b0", "Paid", ["31"], [("30007", "DELIVERED")]),
    ("4", "b0", "Paid", [], None),
    ("5", "b0", "Paid", [], None),
]


@pytest.mark.parametrize("limit", ["2000000", "1"])
def test_feed_of_the_tables(spark, folder, limit):
    spark.conf.set(windows.HOT_ROWS_SETTING, limit)
    try:
        assert nested(feed.derive_raw_orders(spark, folder)) == EXPECTED
    finally:
        spark.conf.unset(windows.HOT_ROWS_SETTING)


def test_lines_are_shuffled_once_by_order(spark, folder):
    plan = feed.derive_raw_orders(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("RepartitionByExpression [l_orderkey") == 1
    plan = feed.derive_raw_orders(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_shuffles_grow_with_the_input_and_are_removed(spark):
    was = spark.conf.get(session.FIRST_PARTITIONS, None)
    try:
        session.scale_shuffles(spark, 1)
        assert session.shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.scale_shuffles(spark, 100 * session.INPUT_PER_PARTITION)
        assert session.shuffle_partitions(spark) == 100
    finally:
        spark.conf.unset(session.FIRST_PARTITIONS) if was is None else spark.conf.set(session.FIRST_PARTITIONS, was)
    before = spark.conf.get(session.CLEAN_SHUFFLES, None)
    kept = store(spark.range(1000).groupBy("id").count(), "counted")
    assert kept.count() == 1000 and spark.conf.get(session.CLEAN_SHUFFLES, None) == before
    assert all(".zstd." in f for f in glob.glob(f"{kept.inputFiles()[0].removeprefix('file:').rsplit('/', 1)[0]}/part-*"))


def test_first_product_reads_no_shipments(spark, folder):
    found = []
    for limit in ("2000000", "1"):
        spark.conf.set(windows.HOT_ROWS_SETTING, limit)
        try:
            m = FeedModels(spark, folder)
            found.append(sorted(map(str, queries.first_product(m).collect())))
        finally:
            spark.conf.unset(windows.HOT_ROWS_SETTING)
        assert not {"fct_orders", "stg_fulfillments"} & set(vars(m))
    assert found[0] == found[1] and len(found[0]) == 3


def test_the_feed_is_landed_when_a_query_reads_it(spark, folder, monkeypatch):
    landed = []
    monkeypatch.setattr(feed, "land_raw_orders", lambda *at: landed.append(at) or feed.derive_raw_orders(*at))
    m = FeedModels(spark, folder)
    spark.createDataFrame([(0, "A", 0)], "n_nationkey long, n_name string, n_regionkey long").write.mode("overwrite").parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string").write.mode("overwrite").parquet(f"{folder}/region.parquet")
    assert queries.scan_lookup_csv(m).count() == 1 and not landed
    assert queries.array_length(m).count() and m.raw is m.raw and len(landed) == 1


def test_staged_models_that_are_read_once_are_not_stored(spark, folder):
    once, kept = FeedModels(spark, folder), FeedModels(spark, folder)
    staged = {"stg_orders", "stg_line_items", "stg_fulfillments"}
    assert all(getattr(kept, name).count() for name in staged) and kept.fct_orders.count()
    for query in ("fct_orders", "order_date_parts", "rejoin_children", "rejoined_totals", "order_quartiles", "order_percent_rank",
                  "monthly_customers", "product_latest_attrs", "check_accepted_values", "dedup_revenue_compare"):
        a, b = (sorted(map(str, getattr(queries, query)(m).collect())) for m in (once, kept))
        assert a == b and (a or query in ("monthly_customers", "check_accepted_values")), query
    assert not (staged | {"fct_orders"}) & set(vars(once))
    # the shuffles of the fact's lines hold what is summed, and no text of a product
    plan = queries.fct_orders(once)._jdf.queryExecution().executedPlan().toString()
    assert "quantity" in plan and "vendor" not in plan and "tracking_number" not in plan


def test_elements_are_made_before_they_are_collected(spark, folder):
    plan = feed.derive_raw_orders(spark, folder)._jdf.queryExecution().executedPlan().toString()
    collected = [x for x in plan.split("\n") if "Aggregate(" in x and "collect_list" in x and "l_orderkey" in x]
    assert collected and not any("struct(" in x for x in collected)


def test_the_latest_of_the_buckets_is_stored_as_it_is_read(spark, monkeypatch):
    stored, real = {}, queries.store
    monkeypatch.setattr(queries, "store", lambda df, label: stored.setdefault(label, df) and real(df, label))
    latest = queries.QUERIES["bucketed_latest_order"](spark, "/root/testdata/sf0.001")
    assert latest.count() == 1500
    assert stored["bucketed"].columns == ["order_id", "payment_status", "total_amount", "synced_at", "_daton_batch_id"]
