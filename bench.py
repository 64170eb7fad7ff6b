"""Time the models and the main operators on one machine and print one JSON line.

The raw feed is made once from the flat tables, as a fixture that no user has to make: it
is timed apart from the total. The staged tables are stored once, as in a real build.
Every query writes all its rows to a sink that drops them. A first pass over the queries
warms the JVM; the second pass is the one reported.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from ledgerloom.catalog.feed_models import FeedModels
from ledgerloom.operators.stored import drop_stored
from ledgerloom.plans import dates, intermediate, marts, staging, variants
from ledgerloom.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def queries(spark):
    """Name and action of each timed step, over models that the first steps build."""
    at = {}

    def land():
        at["m"] = FeedModels(spark, FOLDER)

    def keep_staged():
        m = at["m"]
        m.stg_orders, m.stg_line_items, m.stg_fulfillments  # noqa: B018 - stored on access

    def keep_marts():
        m = at["m"]
        m.fct_orders, m.dim_customers, m.dim_products, m.fct_daily_revenue  # noqa: B018

    yield "land_raw_feed", land
    yield "dedup_latest_order", lambda: run(staging.latest_orders(at["m"].raw))
    yield "stg_orders", lambda: run(staging.stg_orders(at["m"].raw))
    yield "stg_line_items", lambda: run(staging.stg_line_items(at["m"].raw))
    yield "stg_fulfillments", lambda: run(staging.stg_fulfillments(at["m"].raw))
    yield "store_staged", keep_staged
    yield "orders_enriched", lambda: run(at["m"].int_orders_enriched)
    yield "customer_history", lambda: run(at["m"].int_customer_history)
    yield "fct_orders", lambda: run(marts.fct_orders(at["m"].int_orders_enriched))
    yield "dim_customers", lambda: run(marts.dim_customers(at["m"].int_customer_history))
    yield "dim_products", lambda: run(marts.dim_products(at["m"].stg_line_items, at["m"].as_of))
    yield "store_marts", keep_marts
    yield "daily_revenue", lambda: run(marts.fct_daily_revenue(at["m"].fct_orders))
    yield "daily_source_mix", lambda: run(variants.daily_source_mix(at["m"].fct_orders))
    yield "first_last_order_attrs", lambda: run(variants.first_last_order_attrs(at["m"].stg_orders, at["m"].as_of))
    yield "line_summary", lambda: run(intermediate.line_summary(at["m"].stg_line_items))
    yield "dim_dates", lambda: run(dates.dim_dates(dates.spine_over(at["m"].stg_orders, "order_created_at"), at["m"].as_of))
    yield "check_suite", lambda: run(at["m"].check())


def main() -> None:
    spark = build_session(
        "bench", master=f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"), spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for _ in range(2):
        for name, action in queries(spark):
            began = time.perf_counter()
            action()
            seconds[name] = round(time.perf_counter() - began, 3)
    drop_stored(spark)
    fixture = {"land_raw_feed": seconds.pop("land_raw_feed")}
    print(json.dumps({
        "metric": "total time of the models and main operators, second pass",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "fixture": fixture,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
