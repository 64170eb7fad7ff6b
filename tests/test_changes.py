import datetime as dt
import json

import pytest
from builders import order, values

from ledgerloom.operators.dedup import latest_per_key, upsert_latest
from ledgerloom.plans import changes, staging
from ledgerloom.streaming import feed


def test_upsert_equals_rebuild(raw):
    first = [order(str(i), 0, financial_status="PENDING") for i in range(5)]
    second = [order("1", 2), order("1", 1, financial_status="late"), order("9", 1), order("2", -1, total_price="7")]
    by_key = (["order_id"], staging.order_recency())
    kept = latest_per_key(staging.typed_orders(raw(*first)), *by_key)
    now = upsert_latest(kept, staging.typed_orders(raw(*second)), *by_key)
    full = latest_per_key(staging.typed_orders(raw(*first, *second)), *by_key)
    assert sorted(map(str, now.collect())) == sorted(map(str, full.collect()))
    assert now.count() == 6


def test_upsert_of_null_keys(spark):
    kept = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    arrived = spark.createDataFrame([(None, 2)], "k string, v int")
    from pyspark.sql import functions as F

    assert values(upsert_latest(kept, arrived, ["k"], [F.col("v").desc()]), "k", "v") == [("a", 1), (None, 2)]


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_states_of_an_order(raw, hot_rows):
    states = ["PENDING", "PENDING", "PAID", "PAID", "PENDING"]
    df = raw(*[order("1", b, financial_status=s) for b, s in enumerate(states)], order("2", 0, total_price=None))
    rows = sorted(changes.order_versions(df, hot_rows=hot_rows).collect(), key=lambda r: (r.order_id, r.valid_from))
    start = dt.datetime(2024, 1, 1)
    at = [start + dt.timedelta(seconds=s) for s in (0, 2, 4)]
    assert [(r.payment_status, r.valid_from, r.valid_to, r.is_current) for r in rows[:3]] == [
        ("pending", at[0], at[1], False), ("paid", at[1], at[2], False), ("pending", at[2], None, True)]
    assert len(rows) == 4 and rows[3].is_current


def test_surrogate_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b"), ("a", "b")], "x string, y string")
    assert df.select(changes.surrogate_key("x", "y")).distinct().count() == 3


def _deliver(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_stream_appends_each_file_once(spark, raw, tmp_path):
    inbox, table, progress = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "progress")
    first = [order("1", 0, financial_status="PENDING"), order("2", 0)]
    second = [order("1", 1), order("2", 0)]
    _deliver(inbox, "a.json", *first)
    feed.ingest(spark, str(inbox), table, progress)
    _deliver(inbox, "b.json", *second)
    feed.ingest(spark, str(inbox), table, progress)
    feed.ingest(spark, str(inbox), table, progress)
    landed = feed.landed(spark, table)
    assert landed.count() == 4
    got = staging.stg_orders(landed)
    assert sorted(map(str, got.collect())) == sorted(map(str, staging.stg_orders(raw(*first, *second)).collect()))
    assert feed.newest_sync(landed).collect()[0][0] == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_a_late_first_delivery_is_kept(spark, tmp_path):
    inbox, table, progress = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "progress")
    _deliver(inbox, "a.json", order("1", 5_000_000), order("1", 5_000_001))
    feed.ingest(spark, str(inbox), table, progress)
    # synced two months before what has come already
    _deliver(inbox, "b.json", order("9", 0), order("1", 5_000_001))
    feed.ingest(spark, str(inbox), table, progress)
    landed = feed.landed(spark, table)
    assert values(landed, "id") == [("1",), ("1",), ("1",), ("9",)]
    assert values(staging.latest_orders(landed), "order_id", "_daton_batch_id") == [("1", "b5000001"), ("9", "b0")]


def test_keys_of_different_parts_differ(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("␀", "x"), (None, "x"), ("null,", "x"), ("", "x"), ("1:a", ""), ("", "1:a"), ("a1:b", "c"), ("a", "b1:c")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(changes.surrogate_key("x", "y")).distinct().count() == len(rows)


def test_sync_history_is_ordered_and_limited(raw):
    from ledgerloom.operators.dedup import sync_history

    df = raw(*[order(i, b) for i, n in (("1", 2), ("2", 4), ("3", 1), ("4", 4), ("5", 3)) for b in range(n)])
    assert [(r.order_id, r.times_synced) for r in sync_history(df).collect()] == [("2", 4), ("4", 4), ("5", 3), ("1", 2)]
    assert [r.order_id for r in sync_history(df, top=2).collect()] == ["2", "4"]
