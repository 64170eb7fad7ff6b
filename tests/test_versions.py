"""The bucketed store of versions, sketches, and totals over re-joined children."""

import random

import pytest
from builders import by, line, order, shipment, values
from pyspark.sql import functions as F

from ledgerloom.operators.nested import rejoin_children, rejoined_totals
from ledgerloom.plans import marts, staging
from ledgerloom.sources.versions import VersionStore


@pytest.fixture
def store(spark):
    made = VersionStore(spark, "versions_test", "orders", buckets=4)
    yield made
    spark.sql("DROP DATABASE versions_test CASCADE")


def latest(store):
    return store.latest("order_id", staging.ORDER_RECENCY, staging.typed_orders)


def test_latest_versions_without_an_exchange(spark, store, raw):
    with pytest.raises(LookupError):
        store.versions()
    rng = random.Random(2)
    rows = [order(str(rng.randrange(9)), b, financial_status=rng.choice("ab")) for b in range(40)]
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for k in range(0, 40, 10):
        assert store.append(raw(*rows[k:k + 10])) == 10
        now = latest(store)
        assert "Exchange" not in now._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, now.collect())) == sorted(map(str, staging.latest_orders(raw(*rows[:k + 10])).collect()))
        if k == 20:
            assert store.compact() == 3 and store.generation() == 1 and store.compact() == 0
            assert [t.name for t in spark.catalog.listTables("versions_test")] == ["orders_g1_0"]
    assert store.versions().count() == 40 and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == joins


def test_a_compaction_that_stops_leaves_the_old_tables(spark, store, raw, monkeypatch):
    from ledgerloom.sources import versions

    store.append(raw(order("1", 0)))
    store.append(raw(order("1", 1)))
    monkeypatch.setattr(versions, "save_table", lambda *_, **__: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.undo()
    assert store.generation() == 0 and store.versions().count() == 2
    # the new base is there, but the old tables were not dropped yet
    from ledgerloom.sources.tables import save_table

    save_table(store.versions(), "versions_test.orders_g1_0", bucket_by=(4, "id"))
    assert store.versions().count() == 2
    store.append(raw(order("2", 0)))
    assert store.compact() == 2
    assert [t.name for t in spark.catalog.listTables("versions_test")] == ["orders_g2_0"] and store.versions().count() == 3


def test_sketches_of_days_give_months(spark):
    rng = random.Random(1)
    rows = [(f"2024-0{m}-0{d}", 2024, m, f"c{rng.randrange(400)}", False) for m in (1, 2) for d in range(1, 6) for _ in range(300)]
    rows += [("2024-03-01", 2024, 3, None, False), ("2024-03-01", 2024, 3, "x", True)]
    fact = spark.createDataFrame(rows, "order_date string, order_year int, order_month int, customer_id string, is_canceled boolean")
    sketches = marts.daily_customer_sketches(fact)
    found = by(marts.customers_per(sketches, "order_year", "order_month"), "order_month")
    for month in (1, 2):
        exact = len({r[3] for r in rows if r[2] == month})
        assert abs(found[month].unique_customers - exact) <= 0.03 * exact
    assert found[3].unique_customers == 0
    assert abs(marts.customers_per(sketches, "order_year").first().unique_customers - len({r[3] for r in rows if r[2] < 3})) <= 12


def test_totals_equal_those_over_the_product(raw):
    rows = raw(
        order("1", line_items=[line("11", quantity="2"), line("12", quantity="5", title=None)],
              fulfillments=[shipment("f1", shipment_status="DELIVERED", tracking_number="t"), shipment("f2"), shipment("f3")]),
        order("2", line_items=[line("21")]), order("3", fulfillments=[shipment("f4")]), order("4"), order("5", total_price=None, line_items=[line("51")]))
    parts = staging.stg_orders(rows), staging.stg_line_items(rows), staging.stg_fulfillments(rows)
    totals = by(rejoined_totals(*parts), "order_id")
    product = rejoin_children(*parts).groupBy("order_id").agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"), F.count("product_title").alias("titled_rows"),
        F.count_if(F.col("shipment_status") == "delivered").alias("delivered_rows"), F.count("tracking_number").alias("tracked_rows"),
        F.sum("total_amount").alias("repeated_amount"))
    assert {k: tuple(r) for k, r in totals.items()} == {r.order_id: tuple(r) for r in product.collect()}
    assert totals["1"].n_rows == 6 and values(product, "order_id", "n_rows")[0] == ("1", 6)
