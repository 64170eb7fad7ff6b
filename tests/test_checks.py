import pytest
from builders import order

from ledgerloom.checks import rows
from ledgerloom.checks.suite import (
    DECLARED, FURTHER, ON_LOOKUPS, Check, ChecksFailed, enforce, failing_rows, run_suite,
)


@pytest.fixture(scope="module")
def t(spark):
    return spark.createDataFrame(
        [("a", 1, "x@y.zz"), ("a", 2, None), (None, 5, "bad"), (None, None, "q@r.st")], "k string, n int, mail string")


def n(df):
    return df.count()


def test_row_checks(t):
    assert sorted(map(str, (r.k for r in rows.unique(t, "k").collect()))) == ["None", "a"]  # two nulls repeat too
    assert n(rows.not_null(t, "k")) == 2
    assert n(rows.accepted_values(t, "n", [1, 2])) == 1
    assert n(rows.expression(t, "n < 5")) == 1
    assert n(rows.between(t, "n", 2, 4)) == 2 and n(rows.between(t, "n", low=2)) == 1
    assert n(rows.length_between(t, "mail", 4, 9)) == 1
    assert n(rows.matches(t, "mail", "^.+@.+$")) == 1


def test_relationships_ignore_nulls_on_both_sides(spark, t):
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    assert n(rows.relationships(t, "k", parent, "k")) == 2
    assert n(rows.without_children(parent, t, "k")) == 2


def test_table_checks(spark, t):
    assert n(rows.equal_rowcount(t, t)) == 0 and n(rows.equal_rowcount(t, t.limit(1))) == 1
    assert n(rows.fewer_rows(t.limit(1), t)) == 0 and n(rows.fewer_rows(t, t)) == 1
    assert rows.distinct_source_lost(t, "k", t).collect() == [(1, 4)]
    assert n(rows.at_least_one(t, "k")) == 0 and n(rows.at_least_one(t.where("k is null"), "k")) == 1
    assert n(rows.row_count_between(t, 1, 4)) == 0 and n(rows.row_count_between(t, 5, 9)) == 1
    assert n(rows.distinct_count_is(t, "n", 3)) == 0 and n(rows.distinct_count_is(t, "n", 4)) == 1


@pytest.mark.parametrize("as_of, status", [("2024-01-02 00:00:00", "PASS"), ("2024-01-02 00:00:01", "WARN"),
                                           ("2024-01-03 00:00:00", "WARN"), ("2024-01-03 00:00:01", "ERROR")])
def test_freshness_edges(spark, as_of, status):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT timestamp '2024-01-01 00:00:00' AS at UNION ALL SELECT timestamp '2023-01-01 00:00:00'")
    assert rows.freshness(df, F.col("at"), as_of, 24, 48).collect()[0].status == status
    assert n(rows.recency(df, "at", "HOUR", 24, as_of)) == (status != "PASS")
    assert rows.freshness(df.where("false"), F.col("at"), as_of, 24, 48).collect()[0].status == "ERROR"


def test_suite_reports_severity_and_conditions(t):
    checks = [
        Check("t", "not_null", "k"),
        Check("t", "not_null", "mail", where="n = 1", description="mail of ones", owner="data"),
        Check("t", "unique", "k", severity="warn"),
        Check("t", "accepted_values", "n", {"values": (1, 2, 5)}),
        Check("t", "between", "n", {"low": 2}, severity="warn"),
        Check("t", "matches", "mail", {"pattern": "@"}),
        Check("t", "length_between", "mail", {"low": 4, "high": 9}),
        Check("t", "expression", args={"condition": "n > 0"}),
        Check("t", "relationships", "k", {"to": "t", "field": "mail"}),
    ]
    report = {r.check_name: r for r in run_suite(checks, {"t": t}).collect()}
    assert {k: (r.failures, r.status) for k, r in report.items()} == {
        "not_null_t_k": (2, "fail"), "not_null_t_mail_n = 1": (0, "pass"), "unique_t_k": (2, "warn"),
        "accepted_values_t_n": (0, "pass"), "between_t_n": (1, "warn"), "matches_t_mail": (1, "fail"),
        "length_between_t_mail": (1, "fail"), "expression_t_n > 0": (0, "pass"), "relationships_t_k": (2, "fail"),
    }
    assert (report["not_null_t_mail_n = 1"].description, report["not_null_t_mail_n = 1"].owner) == ("mail of ones", "data")
    for check in checks:
        assert n(failing_rows(check, {"t": t})) == report[check.name].failures


def test_enforce_raises_with_samples_for_errors_only(t):
    assert enforce([Check("t", "unique", "k", severity="warn")], {"t": t})[0].status == "warn"
    with pytest.raises(ChecksFailed, match="not_null_t_k.*'n': 5"):
        enforce([Check("t", "not_null", "k")], {"t": t})


def test_declared_checks_pass_on_clean_orders(spark, raw):
    from builders import AS_OF, line, shipment

    from ledgerloom.plans.build import Models

    df = raw(*[order(str(i), customer=str(i % 3), line_items=[line(f"l{i}")], fulfillments=[shipment(f"f{i}")])
               for i in range(6)])
    models = Models(df, AS_OF)
    report = models.check().collect()
    assert len(report) == len(DECLARED) == 49
    assert {r.status for r in report} == {"pass"}
    further = run_suite(FURTHER, models.tables()).collect()
    assert len(further) == len(FURTHER) and {r.status for r in further} == {"pass"}


def test_lookup_checks(spark):
    from ledgerloom.catalog.lookups import lookup

    countries = spark.createDataFrame(
        [("US", "United States", "North America"), ("US", None, "Atlantis")],
        "country_code string, country_name string, region string")
    tables = {"country_codes": countries, "shipping_carriers": lookup(spark, "shipping_carriers")}
    failed = {r.check_name for r in run_suite(ON_LOOKUPS, tables).where("failures > 0").collect()}
    assert failed == {"unique_country_codes_country_code", "not_null_country_codes_country_name",
                      "accepted_values_country_codes_region"}


def test_every_kind_runs_in_a_suite(spark, t):
    parent = spark.createDataFrame([("b",), (None,)], "k string")
    loads = spark.sql("SELECT timestamp '2024-01-01 00:00:00' AS at")
    tables = {"t": t, "parent": parent, "loads": loads, "one": t.limit(1)}
    limits = {"warn_hours": 24, "error_hours": 48}
    checks = [
        (Check("t", "row_count_between", args={"low": 5, "high": 9}), (1, "fail")),
        (Check("t", "equal_rowcount", args={"to": "one"}), (1, "fail")),
        (Check("t", "fewer_rows", args={"to": "one"}, severity="warn"), (1, "warn")),
        (Check("one", "fewer_rows", args={"to": "t"}), (0, "pass")),
        (Check("t", "distinct_source_lost", "k", {"to": "t"}), (1, "fail")),
        (Check("parent", "without_children", "k", {"to": "t"}), (2, "fail")),
        (Check("t", "at_least_one", "k"), (0, "pass")),
        (Check("t", "distinct_count_is", "n", {"expected": 3}), (0, "pass")),
        (Check("loads", "recency", "at", {"part": "HOUR", "count": 1, "as_of": "2024-01-02 00:00:00"}), (1, "fail")),
        (Check("loads", "freshness", "at", {"as_of": "2024-01-02 00:00:00", **limits}), (0, "pass")),
        (Check("loads", "freshness", "at + interval 0 hours", {"as_of": "2024-01-02 12:00:00", **limits}), (1, "warn")),
        (Check("loads", "freshness", "date(at)", {"as_of": "2024-01-09 12:00:00", **limits}), (1, "fail")),
    ]
    report = [(r.check_name, (r.failures, r.status)) for r in run_suite([c for c, _ in checks], tables).collect()]
    assert sorted(report) == sorted((c.name, want) for c, want in checks)


def test_checks_read_together_count_as_alone(spark):
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d"), (9, "e")], "id int, x string")
    child = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "pid int")
    other = spark.createDataFrame([(7,), (1,)], "pid int")
    tables = {"p": parent, "same": parent, "c": child, "o": other}
    checks = [
        Check("p", "unique", "id"), Check("p", "not_null", "x"), Check("same", "not_null", "id"), Check("p", "unique", "x"),
        Check("p", "unique", "id", where="x <> 'b'"), Check("c", "relationships", "pid", {"to": "p", "field": "id"}),
        Check("o", "relationships", "pid", {"to": "same", "field": "id"}),
        Check("o", "relationships", "pid", {"to": "p", "field": "id"}, where="pid > 7"),
    ]
    report = {r.check_name: r.failures for r in run_suite(checks, tables).collect()}
    for c in checks:
        assert report[c.name] == n(failing_rows(c, tables)), c.name
    assert report["relationships_c_pid"] == 2 and report["unique_p_id"] == 2


def test_suite_of_the_models_reads_each_table_once(spark, raw):
    from builders import AS_OF, line, shipment

    from ledgerloom.plans.build import Models

    models = Models(raw(order("1", line_items=[line("l")], fulfillments=[shipment("f")])), AS_OF)
    plan = models.check()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 18 and plan.count("Scan parquet") <= 12
    assert models.check(further=True).count() == len(DECLARED) + len(FURTHER)


def test_checks_of_whole_tables(raw):
    from builders import line, shipment

    from ledgerloom.checks.suite import on_whole_tables
    from ledgerloom.plans.build import Models

    df = raw(*[order(str(i), customer=str(i % 3), line_items=[line(f"l{i}")], fulfillments=[shipment(f"f{i}")]) for i in range(6)],
             order("9", test="true"))
    models = Models(df, "2024-01-03")

    def failing(at):
        report = {r.check_name: r.status for r in run_suite(on_whole_tables(at), models.tables()).collect()}
        return {k.split("_orders")[0]: v for k, v in report.items() if v != "pass"}

    # the test order is lost on purpose, which only warns
    assert failing("2024-01-01 10:00:00") == {"distinct_source_lost_raw": "warn"}
    assert failing("2024-01-02 10:00:00") == {"distinct_source_lost_raw": "warn", "freshness_raw": "warn"}
    assert failing("2024-01-05 10:00:00") == {"distinct_source_lost_raw": "warn", "freshness_raw": "fail", "recency_fct": "warn"}
    assert models.check(at="2024-01-01 10:00:00").count() == len(DECLARED) + len(on_whole_tables("x"))
