"""Run many declared checks and report their failures in one table.

Every table is read once: checks of single rows, the uniqueness of its key and the
relationships that other tables have to that key are counted in one pass, grouped by
the key. Other checks take a pass of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.checks import rows


@dataclass(frozen=True)
class Check:
    """A declared check. ``where`` limits the rows it looks at; only severity ``error`` fails a run."""

    table: str
    kind: str
    column: str | None = None
    args: Mapping = field(default_factory=dict)
    severity: str = "error"
    where: str | None = None
    description: str | None = None
    owner: str | None = None

    @property
    def name(self) -> str:
        parts = (self.kind, self.table, self.column, self.args.get("condition"), self.where)
        return "_".join(x for x in parts if x)


@dataclass(frozen=True)
class Kind:
    """How a check calls its function: the table goes first, ``column`` and ``other`` name the
    parameters that take the check's column and the table it names under ``to``."""

    rows: Callable[..., DataFrame]
    column: str | None = None
    other: str | None = None


def _stale(df: DataFrame, loaded_at: str, **limits) -> DataFrame:
    """The freshness row, unless it passes. ``loaded_at`` is a column or an expression."""
    return rows.freshness(df, F.expr(loaded_at), **limits).where("status <> 'PASS'")


KINDS = {
    "unique": Kind(rows.unique, "column"),
    "not_null": Kind(rows.not_null, "column"),
    "accepted_values": Kind(rows.accepted_values, "column"),
    "relationships": Kind(rows.relationships, "column", "parent"),
    "expression": Kind(rows.expression),
    "between": Kind(rows.between, "column"),
    "length_between": Kind(rows.length_between, "column"),
    "matches": Kind(rows.matches, "column"),
    "without_children": Kind(rows.without_children, "key", "child"),
    "distinct_source_lost": Kind(rows.distinct_source_lost, "key", "target"),
    "equal_rowcount": Kind(rows.equal_rowcount, other="b"),
    "fewer_rows": Kind(rows.fewer_rows, other="b"),
    "recency": Kind(rows.recency, "column"),
    "freshness": Kind(_stale, "loaded_at"),
    "at_least_one": Kind(rows.at_least_one, "column"),
    "row_count_between": Kind(rows.row_count_between),
    "distinct_count_is": Kind(rows.distinct_count_is, "column"),
}

ROW_KINDS = ("not_null", "accepted_values", "expression", "between", "length_between", "matches")


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows that break one check."""
    df, kind = tables[check.table], KINDS[check.kind]
    if check.where:
        df = df.where(check.where)
    args = dict(check.args)
    if kind.other:
        args[kind.other] = tables[args.pop("to")]
    if kind.column:
        args[kind.column] = check.column
    return kind.rows(df, **args)


def breaks(check: Check) -> Column:
    """Whether a row breaks a single-row check; never null."""
    value, a = F.col(check.column) if check.column else None, check.args
    if check.kind == "not_null":
        bad = value.isNull()
    elif check.kind == "accepted_values":
        bad = ~value.isin(*a["values"])
    elif check.kind == "expression":
        bad = ~F.expr(a["condition"])
    elif check.kind == "between":
        bad = F.lit(False)
        if a.get("low") is not None:
            bad = bad | (value < a["low"])
        if a.get("high") is not None:
            bad = bad | (value > a["high"])
    elif check.kind == "length_between":
        bad = ~F.length(value).between(a["low"], a["high"])
    else:
        bad = ~value.rlike(a["pattern"])
    if check.where:
        bad = bad & F.expr(check.where)
    return F.coalesce(bad, F.lit(False))


def report_line(check: Check, failures: Column, severity: Column | None = None) -> Column:
    """A row of the report."""
    text = {
        "check_name": check.name, "table_name": check.table, "column_name": check.column,
        "severity": check.severity, "description": check.description, "owner": check.owner,
    }
    facts = {k: F.lit(v).cast("string") for k, v in text.items()}
    if severity is not None:
        facts["severity"] = severity
    return F.struct(*[c.alias(k) for k, c in facts.items()], failures.cast("long").alias("failures"))


def _report(counts: DataFrame, lines: list[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*lines)))


def _together(df: DataFrame, row_checks: list[Check]) -> DataFrame:
    """Single-row checks of a table, in one pass without a shuffle of rows."""
    counts = df.agg(*[F.count_if(breaks(c)).alias(f"_{i}") for i, c in enumerate(row_checks)])
    return _report(counts, [report_line(c, F.col(f"_{i}")) for i, c in enumerate(row_checks)])


def _by_key(
    df: DataFrame, key: str, unique: list[Check], row_checks: list[Check], pointing: list[tuple[Check, DataFrame]]
) -> DataFrame:
    """A table's keys, those that point to them and the table's broken row checks, counted in one pass and one shuffle.

    A key is repeated if the table has it twice, and missing if only others have it. A broken check is a row of its own
    without a key, which map tasks add up, so that no counter of it goes with each key.
    """
    is_key = F.col("_check") == -1
    found = [F.struct(F.lit(-1).alias("_check"), F.col(key).alias("_key"))]
    for i, c in enumerate(row_checks):
        found.append(F.when(breaks(c), F.struct(F.lit(i).alias("_check"), F.lit(None).cast(df.schema[key].dataType).alias("_key"))))
    own = df.select(F.explode(F.array_compact(F.array(*found))).alias("_found")).select("_found.*", F.lit(-1).alias("_side"))
    sides = [own if row_checks else df.select(F.lit(-1).alias("_check"), F.col(key).alias("_key"), F.lit(-1).alias("_side"))]
    sides += [child.select(F.lit(-1).alias("_check"), F.col(c.column).alias("_key"), F.lit(j).alias("_side")) for j, (c, child) in enumerate(pointing)]
    keyed = reduce(DataFrame.unionByName, sides).groupBy("_check", "_key").agg(
        F.count_if(F.col("_side") == -1).alias("_rows"),
        *[F.count_if(F.col("_side") == j).alias(f"_from_{j}") for j in range(len(pointing))],
    )
    orphaned = is_key & (F.col("_rows") == 0) & F.col("_key").isNotNull()
    counts = keyed.agg(
        F.count_if(is_key & (F.col("_rows") > 1)).alias("_repeated"),
        *[F.coalesce(F.sum(F.when(F.col("_check") == i, F.col("_rows"))), F.lit(0)).alias(f"_{i}") for i in range(len(row_checks))],
        *[F.coalesce(F.sum(F.when(orphaned, F.col(f"_from_{j}"))), F.lit(0)).alias(f"_from_{j}") for j in range(len(pointing))],
    )
    return _report(counts, [
        *[report_line(c, F.col("_repeated")) for c in unique],
        *[report_line(c, F.col(f"_{i}")) for i, c in enumerate(row_checks)],
        *[report_line(c, F.col(f"_from_{j}")) for j, (c, _) in enumerate(pointing)],
    ])


def _alone(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A check with a pass of its own. A stale table is an error or, before that, a warning."""
    broken = failing_rows(check, tables)
    if check.kind != "freshness":
        return _report(broken.agg(F.count("*").alias("n")), [report_line(check, F.col("n"))])
    counts = broken.agg(F.count("*").alias("n"), F.max("status").alias("status"))
    severity = F.when(F.col("status") == "WARN", "warn").otherwise(check.severity)
    return _report(counts, [report_line(check, F.col("n"), severity)])


def run_suite(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: its facts, the number of failing rows, and pass, warn or fail."""
    by_table: dict[int, list[Check]] = {}
    frames: dict[int, DataFrame] = {}
    for check in checks:
        # names that stand for one table are read together
        frame = tables[check.table]
        frames[id(frame)] = frame
        by_table.setdefault(id(frame), []).append(check)
    keys = {
        at: next((c.column for c in group if c.kind == "unique" and not c.where), None) for at, group in by_table.items()
    }
    pointing: dict[int, list[tuple[Check, DataFrame]]] = {}
    parts = []
    for at, group in by_table.items():
        for check in group:
            parent = id(tables[check.args["to"]]) if check.kind == "relationships" else None
            if parent in keys and not check.where and keys[parent] == check.args["field"]:
                pointing.setdefault(parent, []).append((check, frames[at]))
            elif check.kind not in ROW_KINDS and not (check.kind == "unique" and not check.where and check.column == keys[at]):
                parts.append(_alone(check, tables))
    for at, group in by_table.items():
        row_checks = [c for c in group if c.kind in ROW_KINDS]
        unique = [c for c in group if c.kind == "unique" and not c.where and c.column == keys[at]]
        if unique:
            parts.append(_by_key(frames[at], keys[at], unique, row_checks, pointing.get(at, [])))
        elif row_checks:
            parts.append(_together(frames[at], row_checks))
    return with_status(reduce(DataFrame.unionByName, parts))


def with_status(report: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn")
    return report.withColumn("status", status.otherwise("fail"))


class ChecksFailed(Exception):
    pass


def enforce(checks: Iterable[Check], tables: Mapping[str, DataFrame], sample: int = 5) -> list:
    """Run the suite and raise if a check of severity ``error`` fails, with sample rows."""
    checks = list(checks)
    report = run_suite(checks, tables).collect()  # one row per declared check
    failed = {r["check_name"] for r in report if r["status"] == "fail"}
    if failed:
        lines = []
        for check in checks:
            if check.name in failed:
                shown = [r.asDict() for r in failing_rows(check, tables).take(sample)]
                lines.append(f"{check.name}: {shown}")
        raise ChecksFailed("\n".join(lines))
    return report


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c) for c in columns]


def _key(table: str, column: str) -> list[Check]:
    return [Check(table, "unique", column), Check(table, "not_null", column)]


def _one_of(table: str, column: str, values: tuple[str, ...], severity: str = "error") -> Check:
    return Check(table, "accepted_values", column, {"values": values}, severity)


def _points_to(table: str, column: str, to: str) -> Check:
    return Check(table, "relationships", column, {"to": to, "field": column})


def _segments(table: str) -> list[Check]:
    return [
        _one_of(table, "frequency_segment", S.FREQUENCY_SEGMENTS),
        _one_of(table, "recency_segment", S.RECENCY_SEGMENTS),
        _one_of(table, "value_segment", S.VALUE_SEGMENTS),
    ]


# The checks declared on the raw table and the nine models.
DECLARED: tuple[Check, ...] = (
    *_not_null("raw_orders", "id"),
    *_key("stg_orders", "order_id"),
    *_not_null("stg_orders", "customer_id", "order_created_at", "total_amount"),
    _one_of("stg_orders", "payment_status", S.STAGED_PAYMENT_STATUSES),
    _one_of("stg_orders", "fulfillment_status", S.FULFILLMENT_STATUSES),
    *_key("stg_line_items", "line_item_id"),
    *_not_null("stg_line_items", "order_id", "product_title", "quantity", "unit_price"),
    _points_to("stg_line_items", "order_id", "stg_orders"),
    *_key("stg_fulfillments", "fulfillment_id"),
    *_not_null("stg_fulfillments", "order_id", "fulfilled_at"),
    _points_to("stg_fulfillments", "order_id", "stg_orders"),
    *_key("int_orders_enriched", "order_id"),
    *_not_null("int_orders_enriched", "customer_id"),
    _one_of("int_orders_enriched", "order_size_bucket", S.SIZE_BUCKETS),
    *_key("int_customer_history", "customer_id"),
    *_segments("int_customer_history"),
    *_key("fct_orders", "order_id"),
    *_not_null("fct_orders", "customer_id", "order_date", "total_amount"),
    _points_to("fct_orders", "customer_id", "dim_customers"),
    _one_of("fct_orders", "payment_status", S.FACT_PAYMENT_STATUSES, severity="warn"),
    _one_of("fct_orders", "order_size_bucket", S.SIZE_BUCKETS),
    *_key("fct_daily_revenue", "order_date"),
    *_key("dim_customers", "customer_id"),
    _one_of("dim_customers", "customer_tier", S.CUSTOMER_TIERS),
    *_segments("dim_customers"),
    *_key("dim_products", "product_id"),
    _one_of("dim_products", "product_tier", S.PRODUCT_TIERS),
    _one_of("dim_products", "product_status", S.PRODUCT_STATUSES),
)

# The checks documented for the lookup tables.
REGIONS = ("North America", "Europe", "Asia", "South America", "Africa", "Oceania")
CARRIER_TYPES = ("Economy", "Standard", "Express")
ON_LOOKUPS: tuple[Check, ...] = (
    *_key("country_codes", "country_code"),
    *_not_null("country_codes", "country_name", "region"),
    _one_of("country_codes", "region", REGIONS),
    *_key("shipping_carriers", "raw_carrier_name"),
    *_not_null("shipping_carriers", "standardized_name"),
    _one_of("shipping_carriers", "carrier_type", CARRIER_TYPES),
)

# Further checks documented for the models.
FURTHER: tuple[Check, ...] = (
    Check("stg_orders", "between", "total_amount", {"low": 0}),
    Check("stg_orders", "length_between", "customer_email", {"low": 5, "high": 255}),
    Check(
        "stg_orders", "matches", "customer_email",
        {"pattern": r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"},
    ),
    Check("fct_orders", "expression", args={"condition": "total_amount >= 0"}),
    Check(
        "fct_orders", "expression", args={"condition": "discount_amount <= subtotal_amount"},
        description="An order's discount is part of its subtotal", owner="order data",
    ),
    Check("fct_orders", "not_null", "customer_id", where="is_canceled = FALSE"),
)


# The limits documented for the raw feed's age and for the newest order's.
def on_whole_tables(as_of: str) -> tuple[Check, ...]:
    """Checks of tables as wholes, some against the time ``as_of``: freshness of the raw feed by its load time, recency
    of orders, no order lost, customers with orders, and row counts of tables that are made of one another."""
    return (
        Check("raw_orders", "freshness", "timestamp_millis(bigint(_daton_batch_runtime))",
              {"as_of": as_of, "warn_hours": 24, "error_hours": 48}),
        Check("fct_orders", "recency", "order_created_at", {"part": "DAY", "count": 3, "as_of": as_of}, severity="warn"),
        Check("raw_orders", "distinct_source_lost", "id", {"to": "stg_orders"}, severity="warn",
              description="Test orders are left out on purpose"),
        Check("dim_customers", "without_children", "customer_id", {"to": "fct_orders"}),
        Check("fct_orders", "equal_rowcount", args={"to": "stg_orders"}),
        Check("dim_customers", "fewer_rows", args={"to": "stg_orders"}, severity="warn"),
        Check("dim_products", "at_least_one", "product_id"),
    )
