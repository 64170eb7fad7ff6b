import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.checks.suite import Check, run_suite
from ledgerloom.plans import marts


def test_row_checks_do_not_go_through_the_shuffle_by_key(spark):
    t = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "id long, x long")
    report = run_suite([Check("t", "unique", "id"), Check("t", "not_null", "x"), Check("t", "not_null", "id")], {"t": t})
    grouped = [x for x in report._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in x and "_key#" in x.split("]")[0]]
    assert grouped and not any(" AS _0#" in x for x in grouped)
    assert sorted((r.check_name, r.failures) for r in report.collect()) == [("not_null_t_id", 1), ("not_null_t_x", 1), ("unique_t_id", 1)]


def test_lines_before_a_last_sale_stay_where_they_are(spark, monkeypatch):
    rows = [(str(p), None if p == 7 else dt.datetime(2024, 1, 1 + k), f"o{k}", f"{p}-{k}", f"t{p}.{k}") for p in range(40) for k in range(20)]
    names = "product_id string, order_created_at timestamp, order_id string, line_item_id string, product_title string"
    lines = spark.createDataFrame(rows, names)
    lines = lines.withColumns({c: F.col("product_title") for c in marts.PRODUCT_ATTRIBUTES if c != "product_title"})
    expected = sorted(map(tuple, marts.latest_product_attributes(lines).collect()))
    sent, real = [], marts._maybe_last
    monkeypatch.setattr(marts, "_maybe_last", lambda *a: sent.append(real(*a)) or sent[-1])
    monkeypatch.setattr(marts, "BROADCAST_PRODUCTS", 0)
    assert sorted(map(tuple, marts.latest_product_attributes(lines).collect())) == expected and len(expected) == 40
    assert 39 + 20 <= sent[0].count() < len(rows) // 4
    monkeypatch.setattr(marts, "PRODUCT_CELLS", 1)
    assert sorted(map(tuple, marts.latest_product_attributes(lines).collect())) == expected
