import datetime as dt

import pytest
from builders import by, line, order, shipment, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import required_first_element
from ledgerloom.plans import staging


def test_latest_version_wins_and_status_is_lowered(raw):
    df = raw(*[order("1", b, financial_status=s) for b, s in enumerate(["PENDING", "Authorized", "Paid"])])
    row = staging.stg_orders(df).collect()
    assert [(r.order_id, r.payment_status, r._daton_batch_id) for r in row] == [("1", "paid", "b2")]


def test_update_time_then_batch_decide_equal_runtimes(raw):
    same = {"_daton_batch_runtime": "1704067200000"}
    df = raw(
        order("1", 0, updated_at="2024-01-05 00:00:00", total_price="1", **same),
        order("1", 1, updated_at="2024-01-04 00:00:00", total_price="2", **same),
        order("2", 0, total_price="3", **same),
        order("2", 1, total_price="4", **same),
    )
    assert values(staging.stg_orders(df), "order_id", "total_amount") == [("1", 1.0), ("2", 4.0)]


def test_full_ties_are_settled_alike_in_both_readings(raw):
    same = {"batch": 0}
    df = raw(*[order("1", total_price=str(p), test=t, **same) for p, t in [(5, None), (7, "false"), (6, "false")]])
    row = staging.stg_orders(df).collect()[0]
    assert (row.total_amount, row.customer_running_total, row.customer_lifetime_value) == (7.0, 7.0, 7.0)


def test_test_flag_is_read_after_deduplication(raw):
    df = raw(
        order("t", test="true"), order("n", test=None), order("f", test="false"),
        order("late", 0, test="false"), order("late", 1, test="true"),
        order("early", 0, test="true"), order("early", 1, test="false"),
    )
    assert values(staging.stg_orders(df), "order_id") == [("early",), ("f",), ("n",)]


def test_guests_are_one_group_and_keep_their_rows(raw):
    df = raw(
        order("1", customer=None, created_at="2024-01-02 00:00:00"),
        order("2", customer=None, created_at="2024-01-01 00:00:00"),
        {**order("3"), "customer": None},
    )
    got = by(staging.stg_orders(df), "order_id")
    assert {k: (r.customer_id, r.customer_order_sequence) for k, r in got.items()} == {
        "3": (None, 2), "2": (None, 1), "1": (None, 3),
    }


def test_required_first_element_raises_when_empty(raw):
    df = raw(order("1", customer=None))
    with pytest.raises(PySparkException):
        df.select(required_first_element("customer")).collect()


def test_defaults(raw):
    row = staging.stg_orders(raw(order("1"))).collect()[0]
    assert (row.fulfillment_status, row.referring_site) == ("unfulfilled", "direct")
    row = staging.stg_orders(raw(order("1", fulfillment_status="Partial", referring_site="x"))).collect()[0]
    assert (row.fulfillment_status, row.referring_site) == ("partial", "x")


def test_customer_windows(raw):
    df = raw(
        order("a", created_at="2024-01-01 10:00:00", total_price="10"),
        order("c", created_at="2024-01-11 09:00:00", total_price="30"),
        order("b", created_at="2024-01-11 09:00:00", total_price="20"),
        order("z", customer="c2", created_at="2024-01-11 08:00:00", total_price="5"),
    )
    got = by(staging.stg_orders(df), "order_id")
    assert [got[k].customer_order_sequence for k in "abc"] == [1, 2, 3]  # equal times go by id
    assert [got[k].days_since_previous_order for k in "abc"] == [None, 10, 0]
    assert [got[k].customer_running_total for k in "abc"] == [10.0, 30.0, 60.0]
    assert [got[k].is_first_order for k in "abcz"] == [True, False, False, True]
    assert {(got[k].customer_total_orders, got[k].customer_lifetime_value) for k in "abc"} == {(3, 60.0)}
    assert [got[k].daily_order_sequence for k in "azbc"] == [1, 1, 2, 3]


def test_missing_id_keeps_its_row(spark, raw):
    schema = raw(order("1")).schema
    loose = spark.createDataFrame(
        raw(order("1"), order("2")).rdd.map(lambda r: (None if r.id == "2" else r.id, *r[1:])),
        type(schema)([type(f)(f.name, f.dataType, True) for f in schema]),
    )
    assert values(staging.stg_orders(loose), "order_id") == [("1",), (None,)]


def test_lines_over_all_versions(raw):
    df = raw(
        order("1", 0, line_items=[line("9", quantity="2"), line("10", price="30.0")]),
        order("1", 1, line_items=[line("9", quantity="3")]),
        order("2", line_items=[]),
        {**order("3"), "line_items": None},
        order("t", test="true", line_items=[line("5")]),
    )
    got = by(staging.stg_line_items(df), "line_item_id")
    assert set(got) == {"9", "10", "5"}  # the removed line and the test order's line stay
    assert (got["9"].quantity, got["9"].line_total_before_discount) == (3, 30.0)
    assert (got["10"].line_item_sequence, got["9"].line_item_sequence) == (1, 2)  # ids sort as text
    assert got["9"].order_line_item_count == 2 and got["9"].order_total_quantity == 4
    assert got["9"].line_share_of_order == pytest.approx(0.5)
    assert got["5"].is_single_item_order and not got["9"].is_single_item_order
    assert values(staging.lines_of_latest_version(df), "line_item_id") == [("5",), ("9",)]


def test_zero_order_total_has_no_share(raw):
    df = raw(order("1", line_items=[line("1", price="0"), line("2", price="0.0")]))
    assert values(staging.stg_line_items(df), "line_share_of_order") == [(None,), (None,)]


def test_shipments(raw):
    made = "2024-01-01 00:00:00"
    ships = [
        shipment("1", created_at="2024-01-01 00:59:00", tracking_company="FedEx Ground", shipment_status="DELIVERED"),
        shipment("2", created_at="2024-01-02 01:01:00", tracking_company="UPS Mail", shipment_status="In_Transit"),
        shipment("3", created_at="2023-12-31 21:30:00", tracking_company="usps"),
    ]
    df = raw(
        order("a", created_at=made, fulfillments=ships),
        order("b", fulfillments=[]),
        order("c", fulfillments=[shipment("4", tracking_company="DHL eCommerce")]),
        order("d", fulfillments=[shipment("5", tracking_company="OnTrac")]),
        order("e", fulfillments=[shipment("6", tracking_company=None)]),
    )
    got = by(staging.stg_fulfillments(df), "fulfillment_id")
    assert {k: r.hours_to_fulfill for k, r in got.items() if k in "123"} == {"1": 0, "2": 25, "3": -2}
    assert got["2"].days_to_fulfill == 1 and got["3"].days_to_fulfill == 0
    assert [got[k].fulfillment_sequence for k in "312"] == [1, 2, 3]
    assert got["1"].is_split_shipment and not got["4"].is_split_shipment
    assert [got[k].shipping_carrier_standardized for k in "123456"] == [
        "FedEx", "UPS", "USPS", "DHL", "OnTrac", "Unknown",
    ]
    assert (got["1"].is_delivered, got["2"].is_in_transit, got["4"].is_delivered) == (True, True, False)


def test_latest_shipment_by_update_time(raw):
    df = raw(
        order("1", 1, fulfillments=[shipment("1", updated_at="2024-01-05 00:00:00", shipment_status="old")]),
        order("1", 0, fulfillments=[shipment("1", updated_at="2024-01-06 00:00:00", shipment_status="new")]),
    )
    assert values(staging.stg_fulfillments(df), "shipment_status") == [("new",)]


def test_epoch_millis_are_utc(raw):
    df = raw({**order("1"), "_daton_batch_runtime": "1737705606000"})
    text = staging.typed_orders(df).select(F.date_format("synced_at", "yyyy-MM-dd HH:mm:ss")).collect()[0][0]
    assert text == "2025-01-24 08:00:06"


def test_order_of_rows_and_partitions_changes_nothing(raw):
    rows = [
        order(str(i % 40), i // 40, customer=str(i % 7), created_at=f"2024-01-{1 + i % 5:02d} 00:00:00",
              total_price=str(i % 11), line_items=[line(f"{i % 40}-{j}", quantity=str(i % 3 + 1)) for j in range(i % 4)])
        for i in range(120)
    ]
    one = raw(*rows).coalesce(1)
    many = raw(*rows[::-1]).repartition(7)
    for model in (staging.stg_orders, staging.stg_line_items):
        assert sorted(map(str, model(one).collect())) == sorted(map(str, model(many).collect()))


def test_dates_are_calendar_days(raw):
    df = raw(order("1", created_at="2024-01-01 23:59:00"), order("2", created_at="2024-01-02 00:01:00"))
    assert by(staging.stg_orders(df), "order_id")["2"].days_since_previous_order == 1
    assert by(staging.stg_orders(df), "order_id")["2"].previous_order_at == dt.datetime(2024, 1, 1, 23, 59)


def test_split_lines_store_only_what_is_wanted(spark, raw, monkeypatch):
    from ledgerloom.operators import windows

    rows = raw(*[order(str(i), b, line_items=[line(f"{i}{n}", quantity=str(n + b)) for n in range(1, 5)]) for i in range(4) for b in (0, 1)])
    stored = {}

    def noted(real):
        return lambda df, label: stored.setdefault(label, df) and real(df, label)

    for module in (staging, windows):
        monkeypatch.setattr(module, "store", noted(module.store))
    columns = ["order_id", "line_item_id", "line_item_sequence", "order_line_item_count", "order_total_quantity", "line_share_of_order"]
    split = staging.stg_line_items(rows, hot_rows=2, only=("order_id", "line_item_id")).select(*columns)
    assert stored["lines"].columns == list(staging.LINE_WINDOWED)
    assert not {"product_id", "synced_at", "product_title"} & set(stored["split"].columns)
    # the rows of hot orders come from what was stored, not from the feed once more
    assert "line_items" not in stored["split"]._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, split.collect())) == sorted(map(str, staging.stg_line_items(rows).select(*columns).collect()))
