import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import ranking
from ledgerloom.operators import windows as win
from ledgerloom.operators.stored import store
from ledgerloom.plans import staging

METRICS = [
    win.row_number("rn"), win.previous("v", "prev"), win.following("v", "next"),
    win.running_sum("v", "run"), win.group_count("n"), win.group_sum("v", "total"),
    win.first_value("v", "first"), win.last_value("v", "last"),
]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in the null group, a third in one key, ties in the order column."""
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        key = (None, "hot", f"k{rnd.randrange(60)}")[i % 3]
        rows.append((key, rnd.randrange(20), i, None if rnd.random() < 0.2 else float(rnd.randrange(9))))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, id int, v double").repartition(5)


def plain(df, keys, order):
    return win.with_group_metrics(df, keys, order, METRICS)


@pytest.mark.parametrize("limit", [1, 20, 250])
def test_hot_groups_take_the_other_way_to_the_same_result(skewed, limit):
    order = [F.col("t").desc(), F.col("id").asc()]
    hot = win.hot_groups(skewed, {"k": F.col("k")}, limit=limit)
    assert limit < 250 or {r.k for r in hot.collect()} == {None, "hot"}
    split = win.with_group_metrics(skewed, ["k"], order, METRICS, hot)
    want = plain(skewed, ["k"], order)
    assert split.columns == want.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, want.collect()))


def test_small_tables_are_never_split(skewed):
    assert win.hot_groups(skewed, {"k": F.col("k")}, limit=900) is None


def test_limit_is_a_session_setting(spark, skewed):
    spark.conf.set(win.HOT_ROWS_SETTING, "299")
    try:
        assert win.hot_groups(skewed, {"k": F.col("k")}).count() == 2
    finally:
        spark.conf.unset(win.HOT_ROWS_SETTING)


def test_weights_count_as_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9), ("a", 3)], "k string, w int")
    assert [r.k for r in win.hot_groups(df, {"k": F.col("k")}, F.col("w"), 6).collect()] == ["b"]


def test_one_global_group(skewed):
    order = [F.col("t").asc(), F.col("id").asc()]
    split = win.split_window(skewed, [], order, METRICS, chunks=6)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain(skewed, [], order).collect()))


def test_split_needs_no_window_over_rows_of_a_whole_group(skewed):
    split = win.split_window(skewed, ["k"], [F.col("id").asc()], METRICS, chunks=4)
    sizes = split.select("k", "n").distinct().collect()
    assert {(r.k, r.n) for r in sizes if r.k in (None, "hot")} == {(None, 300), ("hot", 300)}


def test_ranks_match_windows(spark, skewed):
    down, up = Window.orderBy(F.col("v").desc()), Window.orderBy(F.col("v").asc())
    got = ranking.with_percent_rank(ranking.with_ranks(skewed, {"r": "v", "r2": "t"}), "v", "p")
    want = skewed.select(
        "*", F.rank().over(down).cast("long").alias("r"),
        F.rank().over(Window.orderBy(F.col("t").desc())).cast("long").alias("r2"),
        F.percent_rank().over(up).alias("p"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("rows", [1, 3, 4, 10, 11])
def test_ntile(spark, rows):
    df = spark.range(rows)
    want = df.select("id", F.ntile(4).over(Window.orderBy("id")).cast("long").alias("q"))
    got = ranking.with_ntile(df, [F.col("id").asc()], 4, "q")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_staged_models_split_alike(spark, raw):
    from builders import line, order, shipment

    rows = []
    for i in range(90):
        rows.append(order(
            str(i % 45), i // 45, customer=("1" if i % 3 else None), total_price=str(i % 7),
            created_at=f"2024-01-{1 + i % 3:02d} 00:00:00",
            line_items=[line(f"{i % 45}.{j}", quantity=str(j + 1)) for j in range(20 if i % 45 == 7 else 2)],
            fulfillments=[shipment(f"{i % 45}.{j}") for j in range(9 if i % 45 == 7 else 1)],
        ))
    df = raw(*rows)
    for model, limit in ((staging.stg_orders, 8), (staging.stg_line_items, 15), (staging.stg_fulfillments, 6)):
        plain_rows, split_rows = model(df).collect(), model(df, hot_rows=limit).collect()
        assert sorted(map(str, plain_rows)) == sorted(map(str, split_rows))


_rows = st.lists(
    st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))),
    min_size=1, max_size=40,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_rows, chunks=st.integers(1, 5))
def test_any_group_may_be_split(spark, rows, chunks):
    numbered = [(k, t, i, None if v is None else float(v)) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "k string, t int, id int, v double")
    order = [F.col("t").asc(), F.col("id").desc()]
    split = win.split_window(df, ["k"], order, METRICS, chunks=chunks)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain(df, ["k"], order).collect()))


def test_hot_groups_of_several_keys_in_one_pass(spark):
    df = spark.range(300).selectExpr("IF(id % 3 = 0, NULL, concat('k', id % 100)) AS k", "date_add(date'2024-01-01', int(id % 4)) AS d")
    found = win.hot_groups_together(df, {"k": F.col("k"), "d": F.col("d")}, limit=60)
    assert [r.k for r in found["k"].collect()] == [None] and found["d"].count() == 4
    assert found["d"].schema["d"].dataType == df.schema["d"].dataType
    assert win.hot_groups_together(df, {"k": F.col("k"), "d": F.col("d")}, limit=80)["d"] is None
    assert win.hot_groups_together(df, {"k": F.col("k")}, limit=300) == {"k": None}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([None, *"abcdefgh"]), st.integers(0, 9)), min_size=1, max_size=50), limit=st.integers(0, 30))
def test_the_screen_loses_no_hot_group(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(win, "SCREEN_CELLS", (2, 4))  # several keys to a cell
    totals = {}
    for k, w in rows:
        totals[k] = totals.get(k, 0) + w
    hot = win.hot_groups(spark.createDataFrame(rows, "k string, w int"), {"k": F.col("k")}, F.col("w"), limit)
    assert sorted(map(str, [r.k for r in hot.collect()] if hot else [])) == sorted(str(k) for k, n in totals.items() if n > limit)


def test_no_key_is_shuffled_where_nothing_is_hot(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(win, "store", lambda df, label: stored.append((label, df)) or store(df, label))
    ids = spark.range(20_000).selectExpr("concat('k', id) AS k")
    assert win.hot_groups(ids, {"k": F.col("k")}, limit=1000) is None
    (label, cells), = stored
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert label == "cells" and plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_cell" in plan
    one = ids.unionByName(spark.range(2000).selectExpr("'k7' AS k"))
    assert [r.k for r in win.hot_groups(one, {"k": F.col("k")}, limit=1000).collect()] == ["k7"]
