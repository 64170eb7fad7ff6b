from builders import line, order

from ledgerloom.checks.suite import on_whole_tables
from ledgerloom.plans.build import Models


def test_only_models_that_are_checked_are_kept(raw):
    kept = []
    models = Models(raw(order("1", 0, line_items=[line("1")])), "2024-07-01", keep=lambda df, name: kept.append(name) or df)
    checks = on_whole_tables("2024-07-01 00:00:00")
    tables = models.tables(checks)
    assert sorted(kept) == ["dim_customers", "dim_products", "fct_orders", "stg_line_items", "stg_orders"]
    assert kept.index("stg_line_items") < kept.index("fct_orders")
    assert {t for c in checks for t in (c.table, c.args.get("to")) if t} == set(tables)
