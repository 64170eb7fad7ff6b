"""The snapshot table against the states computed from all versions."""

import random

import pytest
from builders import order

from ledgerloom.plans import changes
from ledgerloom.plans.snapshot import OrderSnapshot


def states(df):
    return sorted(map(str, df.select("order_id", *changes.TRACKED, "valid_from", "valid_to", "is_current").collect()))


def agrees(snapshot, raw):
    assert states(snapshot.rows()) == states(changes.order_versions(raw))


@pytest.fixture
def snapshot(spark, tmp_path):
    return OrderSnapshot(spark, str(tmp_path / "snapshot"), buckets=4)


def test_merges_equal_the_recomputation(snapshot, raw):
    rng = random.Random(1)
    versions = [order(str(i), b, financial_status=rng.choice(["PENDING", "PAID"]), total_price=f"{rng.randrange(2)}.0") for i in range(8) for b in range(8)]
    rng.shuffle(versions)  # so most loads have versions that are late
    for k in range(0, len(versions), 32):
        snapshot.merge(raw(*versions[k:k + 32]))
        agrees(snapshot, raw(*versions[:k + 32]))


def test_on_time_merges_read_no_closed_row(snapshot, raw, monkeypatch):
    first = [order("1", 0, financial_status="PENDING"), order("2", 0), order("3", 0)]
    second = [order("1", 1, financial_status="PAID"), order("1", 2, financial_status="PAID"), order("4", 1)]
    third = [order("1", 3, financial_status="PENDING"), order("2", 3), order("4", 4, financial_status="void")]
    snapshot.merge(raw(*first))
    read = []
    kept = type(snapshot.tables).kept
    monkeypatch.setattr(type(snapshot.tables), "kept", lambda self, name, *more: (read.append(name), kept(self, name, *more))[1])
    for n, rows in enumerate((second, third), 2):
        assert snapshot.merge(raw(*rows)) == n
    assert set(read) == {"open"}
    agrees(snapshot, raw(*first, *second, *third))
    closed = snapshot.tables.table("closed")
    assert {r.part_load for r in closed.collect()} == {2, 3}


def test_a_late_version_splits_a_state_that_was_closed(snapshot, raw):
    loads = [
        [order("1", 0, financial_status="A"), order("2", 0, financial_status="A")], [order("1", 6, financial_status="A"), order("2", 1, financial_status="B")],
        [order("1", 9, financial_status="C")], [order("1", 3, financial_status="B")],  # between two versions of one state
    ]
    for rows in loads:
        snapshot.merge(raw(*rows))
    agrees(snapshot, raw(*[r for rows in loads for r in rows]))
    assert snapshot.rows().where("order_id = '1'").count() == 4


def test_a_load_is_merged_once_and_taken_up(snapshot, raw, monkeypatch):
    first, second = [order("1", 0, financial_status="A")], [order("1", 1, financial_status="B"), order("2", 1)]
    snapshot.merge(raw(*first))
    tables, publish = type(snapshot.tables), type(snapshot.tables).publish
    monkeypatch.setattr(tables, "publish", lambda self, load: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        snapshot.merge(raw(*second), load=2)
    monkeypatch.setattr(tables, "publish", publish)
    assert snapshot.merge(raw(*second), load=2) == 2
    assert snapshot.merge(raw(*second), load=2) == 2
    agrees(snapshot, raw(*first, *second))


def test_a_repeated_delivery_changes_nothing(snapshot, raw):
    rows = [order("1", b, financial_status=s) for b, s in enumerate("AAB")]
    for _ in range(3):
        snapshot.merge(raw(*rows))
        agrees(snapshot, raw(*rows))


def test_overwriting_keeps_the_newest_state_only(spark, raw, tmp_path):
    snapshot = OrderSnapshot(spark, str(tmp_path / "one"), buckets=4, history=False)
    loads = [[order("1", 0, financial_status="A"), order("2", 5, financial_status="A")], [order("1", 2, financial_status="B"), order("2", 1, financial_status="late"), order("3", 1)]]
    for rows in loads:
        snapshot.merge(raw(*rows))
    assert sorted((r.order_id, r.payment_status) for r in snapshot.rows().collect()) == [("1", "b"), ("2", "a"), ("3", "paid")]


def test_hot_orders_and_empty_loads(spark, raw, tmp_path):
    snapshot = OrderSnapshot(spark, str(tmp_path / "hot"), buckets=2, hot_rows=2)
    rows = [order("1", b, financial_status="AB"[b % 2]) for b in range(9)]
    snapshot.merge(raw(*rows[:5]))
    snapshot.merge(raw(*rows).limit(0))
    snapshot.merge(raw(*rows[5:], rows[0]))
    agrees(snapshot, raw(*rows))
