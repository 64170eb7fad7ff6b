"""Rebuilds beside the tables in use: what readers see before, during and after."""

import pytest
from builders import AS_OF, line, order

from ledgerloom.plans.build import build
from ledgerloom.plans.release import prune, release, releases, shown, switch
from ledgerloom.sources import tables


def _orders(raw, n):
    return raw(*[order(str(i), customer=str(i % 3), line_items=[line(f"l{i}")]) for i in range(n)])


def _kinds(spark, database):
    return {t.tableType for t in spark.catalog.listTables(database) if not t.isTemporary}


def _seen(spark, database):
    return spark.table(f"{database}_staging.stg_orders").count(), spark.table(f"{database}_marts.fct_orders").count()


def test_releases_replace_each_other_and_failures_change_nothing(spark, raw):
    build(spark, _orders(raw, 2), "rel", AS_OF)  # in place, before the first release
    release(spark, _orders(raw, 4), "rel", AS_OF, buckets=4)
    assert _seen(spark, "rel") == (4, 4) and releases(spark, "rel") == [1]
    assert _kinds(spark, "rel_staging") == _kinds(spark, "rel_marts") == {"VIEW"}
    # views keep what the tables have: description, comments, buckets
    assert spark.catalog.getTable("rel_marts.fct_orders").description.endswith("Grain: one row per order.")
    comments = {c.name: c.description for c in spark.catalog.listColumns("rel_marts.fct_orders")}
    assert comments == {c.name: c.description for c in spark.catalog.listColumns("rel_r1.fct_orders")} and any(comments.values())
    plan = spark.table("rel_staging.stg_orders").groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan

    def reject(models):
        assert models.fct_orders.count() == 6  # all is built
        assert _seen(spark, "rel") == (4, 4)
        raise ValueError("rejected")

    with pytest.raises(ValueError, match="rejected"):
        release(spark, _orders(raw, 6), "rel", AS_OF, check=reject)
    broken = raw(order("1", total_price="no number"))  # fails half way, in a cast
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        release(spark, broken, "rel", AS_OF)
    assert _seen(spark, "rel") == (4, 4) and releases(spark, "rel") == [1]
    with pytest.raises(LookupError):
        switch(spark, "rel", 2)

    release(spark, _orders(raw, 5), "rel", AS_OF)
    assert _seen(spark, "rel") == (5, 5) and releases(spark, "rel") == [1, 4]
    assert not spark.catalog.databaseExists("rel_r2") and not spark.catalog.databaseExists("rel_r3")
    switch(spark, "rel", 1)  # and back again
    assert _seen(spark, "rel") == (4, 4) and shown(spark, "rel") == {1}
    assert prune(spark, "rel", keep=1) == []  # what is shown stays
    switch(spark, "rel", 4)
    assert prune(spark, "rel", keep=1) == [1] and _seen(spark, "rel") == (5, 5)


def test_a_shown_table_may_change_its_columns(spark):
    tables.ensure_database(spark, "shown")
    tables.save_table(spark.sql("SELECT 1 a"), "shown.one", columns={"a": "it's one"})
    tables.save_table(spark.sql("SELECT 'x' b, 2 c"), "shown.two", properties={"team": "a'b"})
    tables.show_table(spark, "shown.one", "shown.v")
    assert spark.table("shown.v").schema["a"].metadata["comment"] == "it's one"
    tables.show_table(spark, "shown.two", "shown.v")
    assert spark.table("shown.v").columns == ["b", "c"]
    kept = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES shown.v").collect()}
    assert kept["team"] == "a'b"


def test_a_lookup_that_fails_to_load_leaves_the_old_one(spark):
    tables.ensure_database(spark, "raw_b")
    tables.replace_lookup(spark.sql("SELECT 1 a"), "raw_b.lk")
    with pytest.raises(Exception, match="broken"):
        tables.replace_lookup(spark.sql("SELECT raise_error('broken') a FROM range(3)"), "raw_b.lk")
    assert [r.a for r in spark.table("raw_b.lk").collect()] == [1]
    assert tables.replace_lookup(spark.sql("SELECT 'x' b, 2 c"), "raw_b.lk") == 1
    assert spark.table("raw_b.lk").columns == ["b", "c"]


def test_command_shows_a_release_only_if_its_checks_pass(spark, tmp_path):
    import json

    from ledgerloom import schema as S
    from ledgerloom.__main__ import run
    from ledgerloom.checks.suite import ChecksFailed

    def feed(name, *rows):
        path = tmp_path / name
        path.write_text("\n".join(json.dumps({f: r.get(f) for f in S.RAW_ORDERS.names}, default=str) for r in rows))
        return str(path)

    good = feed("good.jsonl", *[order(str(i), line_items=[line(f"l{i}")]) for i in range(3)])
    out = run(spark, raw=good, database="shown_shop", as_of=AS_OF, release=True, export=str(tmp_path / "out"))
    assert out["checks"] == {"pass": 55} and "fct_orders" in out["exported"]
    bad = feed("bad.jsonl", order("1", customer=None, total_price="-5.0", line_items=[line("l1")]))
    with pytest.raises(ChecksFailed, match="total"):
        run(spark, raw=bad, database="shown_shop", as_of=AS_OF, release=True)
    assert spark.table("shown_shop_marts.fct_orders").count() == 3
