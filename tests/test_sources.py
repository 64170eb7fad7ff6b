import csv
import datetime as dt
import json
import os

import pytest
from builders import AS_OF, line, order
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.plans.build import build
from ledgerloom.session import shared_folder
from ledgerloom.sources import files, tables


def write_jsonl(path, *rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def test_jsonl_keeps_arrays_nested(spark, tmp_path):
    doc = order("1", line_items=[line("1"), line("2")])
    path = write_jsonl(tmp_path / "o.jsonl", doc, {"id": "2"})
    typed = files.read_jsonl(spark, path)
    assert typed.schema.names == S.RAW_ORDERS.names
    got = {r.id: r for r in typed.collect()}
    assert [x.id for x in got["1"].line_items] == ["1", "2"] and got["2"].line_items is None
    inferred = files.read_jsonl(spark, path, schema=None)
    assert inferred.schema["line_items"].dataType.typeName() == "array"


def test_missing_file_stops_with_its_name(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.jsonl"):
        files.read_jsonl(spark, str(tmp_path / "nowhere.jsonl"))
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        files.read_lookup(spark, str(tmp_path / "nowhere.csv"))


def test_broken_json_fails_the_load(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text('{"id": "1"}\nnot json\n')
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        files.read_jsonl(spark, str(tmp_path / "o.jsonl")).collect()


def test_lookup_types_given_or_detected(spark, tmp_path):
    path = tmp_path / "zip.csv"
    path.write_text("zip_code,population\n01234,50000\n")
    assert files.read_lookup(spark, str(path), S.ZIP_CODES).collect() == [("01234", 50000)]
    assert files.read_lookup(spark, str(path)).collect() == [(1234, 50000)]


def test_database_load_and_row_count(spark):
    assert tables.ensure_database(spark, "raw_a") is True
    assert tables.ensure_database(spark, "raw_a") is False
    assert tables.save_table(spark.range(5), "raw_a.t") == 5
    assert tables.save_table(spark.range(3), "raw_a.t") == 3  # replaces
    assert spark.table("raw_a.t").count() == 3
    source = tables.Source("t", schema="raw_b")
    assert source.read(spark, {"raw_schema": "raw_a"}).count() == 3
    assert source.name() == "`raw_b`.`t`"
    assert tables.Source("t", "s", "c").name() == "`c`.`s`.`t`"


def test_lookup_replacement_may_change_columns(spark):
    tables.ensure_database(spark, "raw_a")
    tables.replace_lookup(spark.sql("SELECT 1 a"), "raw_a.lk")
    assert tables.replace_lookup(spark.sql("SELECT 'x' b, 2 c"), "raw_a.lk") == 1
    assert spark.table("raw_a.lk").columns == ["b", "c"]


def test_descriptions_are_stored(spark):
    tables.ensure_database(spark, "raw_a")
    tables.save_table(spark.range(1), "raw_a.d", description="It's a table", columns={"id": "The key"},
                      properties={"team": "data"})
    assert spark.catalog.getTable("raw_a.d").description == "It's a table"
    assert spark.catalog.listColumns("raw_a.d")[0].description == "The key"
    shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES raw_a.d").collect()}
    assert shown["team"] == "data"


def test_views_are_lazy(spark):
    tables.save_view(spark.range(4), "a_view")
    assert spark.table("a_view").count() == 4


def test_export_writes_every_table(spark, tmp_path):
    tables.ensure_database(spark, "mart_x")
    df = spark.sql("""SELECT 1.5D x, 'a,"b' s, CAST(NULL AS STRING) n, '' e, true b, date '2024-01-02' d,
                      timestamp '2024-01-02 03:04:05.123456' t, array(1, 2) l, ' p ' w""")
    tables.save_table(df, "mart_x.one")
    tables.save_table(spark.range(2), "mart_x.two")
    out = tables.export_database(spark, "mart_x", str(tmp_path))
    assert sorted(out) == ["one", "two"]
    parts = sorted((tmp_path / "one").glob("*.csv"))
    with parts[0].open(newline="") as f:
        header, row = list(csv.reader(f))
    assert header == list("xsnebdtlw")
    assert row == ["1.5", 'a,"b', "", "", "True", "2024-01-02", "2024-01-02 03:04:05.123456+00:00", "[1,2]", " p "]
    assert '""' not in parts[0].read_text().replace('""b', "")


def test_export_of_an_empty_database_stops(spark, tmp_path):
    tables.ensure_database(spark, "mart_empty")
    with pytest.raises(LookupError, match="No tables found in mart_empty"):
        tables.export_database(spark, "mart_empty", str(tmp_path))


def _tables(spark, database):
    return {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_build_saves_all_models_and_buckets_spare_shuffles(spark, raw):
    df = raw(*[order(str(i), customer=str(i % 3), line_items=[line(f"l{i}")]) for i in range(8)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        models = build(spark, df, "built", as_of=AS_OF, buckets=4)
        assert _tables(spark, "built_staging") == {"stg_orders", "stg_line_items", "stg_fulfillments"}
        assert _tables(spark, "built_marts") == {
            "fct_orders", "fct_daily_revenue", "dim_customers", "dim_products", "dim_dates"}
        assert models.int_orders_enriched.count() == 8
        assert _exchanges(models.int_orders_enriched) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.table("built_marts.fct_daily_revenue").collect()[0].order_date == dt.date(2024, 1, 1)
    about = spark.catalog.getTable("built_marts.fct_orders").description
    assert about.endswith("Grain: one row per order.")


def test_command_loads_builds_checks_and_exports(spark, tmp_path):
    from ledgerloom.__main__ import run

    path = write_jsonl(tmp_path / "o.jsonl", *[order(str(i), line_items=[line(f"l{i}")]) for i in range(3)])
    out = run(spark, raw=path, database="shop", as_of=AS_OF, export=str(tmp_path / "out"), views=True)
    assert out["loaded"] == 3 and out["checks"] == {"pass": 55}
    assert sorted(out["exported"]) == ["dim_customers", "dim_dates", "dim_products", "fct_daily_revenue", "fct_orders"]
    assert spark.table("shop_raw.orders").count() == 3 and _tables(spark, "shop_staging") == set()


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_nothing_runs_python_per_row(spark, raw):
    from ledgerloom.plans import marts, staging

    df = raw(order("1", line_items=[line("1")]))
    for frame in (staging.stg_orders(df), staging.stg_line_items(df), staging.stg_fulfillments(df),
                  marts.product_sums(staging.stg_line_items(df))):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_a_model_needs(spark, raw, tmp_path):
    from ledgerloom.plans import staging

    raw(order("1", line_items=[line("1")])).write.parquet(str(tmp_path / "r"))
    stored = spark.read.schema(S.RAW_ORDERS).parquet(str(tmp_path / "r"))
    plan = staging.order_metrics(stored)._jdf.queryExecution().executedPlan().toString()
    assert "line_items" not in plan and "email" not in plan
    size = stored.select(F.sum(F.size("line_items.id")))._jdf.queryExecution().executedPlan().toString()
    assert "line_items:array<struct<id:string>>" in size
    lines = staging.stg_line_items(stored)._jdf.queryExecution().executedPlan().toString()
    assert lines.count("Exchange hashpartitioning") == 1


def test_exported_doubles_are_plain_and_read_back(spark, tmp_path):
    import csv
    import math
    import random

    from ledgerloom.sources.tables import export_csv

    rng = random.Random(1)
    numbers = [12345678.9, 0.0001, -1e-7, 1e16, 123456789012345680.0, 5e-324, 1.7976931348623157e308, 0.0, -0.0, 1.0, 10000000.0, -2.5e7, 0.1 + 0.2]
    numbers += [rng.uniform(-1, 1) * 10 ** rng.randrange(-30, 30) for _ in range(300)]
    export_csv(spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double"), str(tmp_path / "out"))
    got = {}
    for part in (tmp_path / "out").glob("part-*.csv"):
        for row in csv.DictReader(part.open()):
            assert "E" not in row["x"] and "e" not in row["x"]
            got[int(row["i"])] = float(row["x"])
    assert all(got[i] == x and math.copysign(1, got[i]) == math.copysign(1, x) for i, x in enumerate(numbers))


def test_calendar_covers_orders_outside_its_span(spark, raw):
    from ledgerloom.plans import dates
    from ledgerloom.plans.build import Models

    models = Models(raw(order("1", created_at="2018-03-05 10:00:00"), order("2", created_at="2032-02-01 00:00:00")), "2024-01-01")
    days = models.dim_dates.agg({"date_day": "min"}).collect()[0][0], models.dim_dates.agg({"date_day": "max"}).collect()[0][0]
    assert [str(d) for d in days] == ["2018-03-05", "2032-02-01"]
    months = {r.year_month: r.revenue for r in dates.revenue_per_month(models.dim_dates, models.fct_orders).collect()}
    assert months["2018-03"] == 50.0 and months["2032-02"] == 50.0 and months["2025-07"] == 0.0


def test_a_range_of_dates_reads_its_months_only(spark, raw):
    from ledgerloom.plans import marts
    from ledgerloom.plans.build import build

    rows = [order(str(i), created_at=f"2024-{i:02d}-15 10:00:00") for i in range(1, 10)]
    models = build(spark, raw(*rows), "bymonth", "2024-12-01")
    late = marts.ordered_since(models.fct_orders, "2024-08-10")
    assert sorted(r.order_id for r in late.collect()) == ["8", "9"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "order_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_jsonl_is_compressed_and_split(spark, tmp_path, monkeypatch, raw):
    monkeypatch.setattr(files, "RECORDS_PER_FILE", 2)
    rows = raw(*[{"id": str(i), "line_items": [{"id": "1"}] if i % 2 else []} for i in range(5)]).coalesce(1)
    path = str(tmp_path / "orders")
    for times in (1, 2):
        files.write_jsonl(rows, path, mode="append")
        read = files.read_jsonl(spark, path)
        assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect() * times))
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(names) == 6 and all(n.endswith(".json.gz") for n in names)


def test_saved_tables_are_zstd_and_leave_the_setting_of_shuffles(spark):
    from ledgerloom import session

    before = spark.conf.get(session.CLEAN_SHUFFLES, None)
    tables.save_table(spark.range(100).selectExpr("cast(id as string) AS id"), "zstd_kept", bucket_by=(2, "id"))
    kept = spark.table("zstd_kept")
    assert kept.count() == 100 and all(".zstd." in f for f in kept.inputFiles())
    assert spark.conf.get(session.CLEAN_SHUFFLES, None) == before
    spark.sql("DROP TABLE zstd_kept")


def test_nearly_unique_columns_are_written_without_a_dictionary(spark, tmp_path):
    import pyarrow.parquet as pq

    from ledgerloom.operators.stored import store

    rows = spark.range(0, 40_000, 1, 1).selectExpr("concat('order-', id) AS id", "concat('state-', id % 5) AS state")
    tables.save_table(rows, "plainly_kept")
    for kept in (spark.table("plainly_kept"), store(rows, "plain")):
        (file,) = kept.inputFiles()
        held = pq.ParquetFile(file.removeprefix("file://").removeprefix("file:")).metadata.row_group(0)
        assert ["PLAIN" in held.column(i).encodings for i in (0, 1)] == [True, False]
    spark.sql("DROP TABLE plainly_kept")
