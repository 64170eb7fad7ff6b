"""Every query by name: what it reads and which library functions answer it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.catalog.feed_models import FeedModels, comparable, models_for
from ledgerloom.catalog.lookups import lookup
from ledgerloom.checks import rows as checks
from ledgerloom.checks.suite import FURTHER, on_whole_tables, run_suite
from ledgerloom.functions import segments
from ledgerloom.functions.scalars import divide_or_null, from_epoch_millis, required_first_element
from ledgerloom.operators import dedup, lookup as lk, nested, profile, ranking
from ledgerloom.operators import windows as win
from ledgerloom.operators.stored import new_folder, store
from ledgerloom.plans import changes, dates, intermediate as mid, marts, staging, variants
from ledgerloom.plans.incremental import IncrementalBuild
from ledgerloom.plans.snapshot import OrderSnapshot
from ledgerloom.session import shuffle_partitions
from ledgerloom.sources import files, tables
from ledgerloom.sources.versions import VersionStore
from ledgerloom.streaming import feed as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EVENTS_AS_OF = "2024-02-01 06:00:00"
STAR_SINCE = "2000-01-01"
INCREMENT_AT = "1998-06-01"


def query(answer: Callable[[FeedModels], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(answer(models_for(spark, folder)))

    QUERIES[answer.__name__] = run
    return answer


# --- sources -----------------------------------------------------------------

@query
def scan_jsonl(m):
    path = new_folder(m.spark, "jsonl")
    files.write_jsonl(m.raw, path)
    read = files.read_jsonl(m.spark, path)
    # every column and every field of the arrays' elements; amounts and times in a form that other engines print alike
    times = ("created_at", "processed_at", "updated_at", "closed_at", "cancelled_at")
    amounts = [c for c in read.columns if c.startswith("total_") or c == "subtotal_price"]
    texts = [c for c in read.columns if c not in (*times, *amounts, "id", "customer", "shipping_address", "line_items", "fulfillments")]

    def elements(array, names):
        def shown(e, name):
            made = F.date_format(e[name].cast("timestamp"), "yyyy-MM-dd HH:mm:ss") if name in times else e[name]
            return F.coalesce(made, F.lit("~"))

        return F.coalesce(F.array_join(F.transform(array, lambda e: F.concat_ws("|", *[shown(e, n) for n in names])), ";"), F.lit(""))

    def total(field):
        return F.aggregate("line_items", F.lit(0.0), lambda a, e: a + e[field].cast("double"))

    return read.select(
        F.col("id").alias("order_id"), *texts,
        *[F.col(c).cast("timestamp").alias(c) for c in times], *[F.col(c).cast("double").alias(c) for c in amounts],
        elements("customer", ["id"]).alias("customers"),
        nested.array_length("line_items").alias("n_lines"),
        elements("line_items", [n for n in S.LINE_ITEM_FIELDS if n not in ("price", "total_discount")]).alias("lines"),
        total("price").alias("line_prices"), total("total_discount").alias("line_discounts"),
        nested.array_length("fulfillments").alias("n_fulfillments"),
        elements("fulfillments", S.FULFILLMENT_FIELDS).alias("shipments"),
    )


@query
def scan_lookup_csv(m):
    path = new_folder(m.spark, "lookup")
    _countries(m).write.option("header", True).csv(path)
    return files.read_lookup(m.spark, path, S.COUNTRY_CODES)


def _countries(m):
    nation, region = m.table("nation"), m.table("region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return joined.select(
        F.col("n_nationkey").cast("string").alias("country_code"),
        F.col("n_name").alias("country_name"), F.col("r_name").alias("region"),
    )


@query
def raw_profile(m):
    return profile.load_profile(m.raw)


# --- projections, casts, predicates --------------------------------------------

@query
def project_rename(m):
    return staging.typed_orders(m.raw).select("order_id", "order_name", "order_source", "customer_email")


@query
def cast_types(m):
    return staging.typed_orders(m.raw).select(
        "order_id", "_daton_batch_id", "order_number", "order_created_at", "order_updated_at",
        "subtotal_amount", "tax_amount", "is_test_order", "accepts_marketing",
    )


@query
def epoch_millis(m):
    return m.raw.select(
        F.col("id").alias("order_id"), "_daton_batch_id",
        from_epoch_millis("_daton_batch_runtime").alias("synced_at"),
    )


@query
def customer_from_array(m):
    return staging.typed_orders(m.raw).select("order_id", "_daton_batch_id", "customer_id")


@query
def null_defaults(m):
    return staging.typed_orders(m.raw).select(
        "order_id", "_daton_batch_id", "payment_status", "fulfillment_status",
        "referring_site", "cancellation_reason",
    )


@query
def exclude_test_orders(m):
    return staging.real_orders(staging.latest_orders(m.raw)).select("order_id", "is_test_order")


@query
def filter_null_keys(m):
    lines = m.once("stg_line_items").where(F.col("product_id").isNotNull())
    return lines.select("order_id", "line_item_id", "product_id")


@query
def order_size_bucket(m):
    size = segments.order_size(F.col("total_amount"))
    return m.once("stg_orders").select("order_id", "total_amount", size.alias("order_size_bucket"))


@query
def frequency_segment(m):
    return m.int_customer_history.select(
        "customer_id", "total_orders", "days_since_last_order", "lifetime_revenue",
        "frequency_segment", "recency_segment", "value_segment",
    )


@query
def rfm_segment(m):
    return m.dim_customers.select("customer_id", "rfm_segment")


@query
def customer_tier(m):
    return m.dim_customers.select("customer_id", "customer_tier", "is_at_churn_risk", "has_marketing_consent")


@query
def carrier_standardize(m):
    return m.once("stg_fulfillments").select(
        "fulfillment_id", "shipping_carrier",
        segments.carrier(F.col("shipping_carrier")).alias("shipping_carrier_standardized"),
    )


@query
def line_total(m):
    return staging.typed_lines(m.raw).select(
        "order_id", "line_item_id", "_daton_batch_id", "quantity", "unit_price",
        "line_total_before_discount",
    )


@query
def date_relative_flags(m):
    flags = dates.relative_flags(F.col("date_day"), F.lit(m.as_of).cast("date"))
    spine = dates.spine_over(m.once("stg_orders"), "order_created_at")
    return spine.select("date_day", *[c.alias(n) for n, c in flags.items()])


@query
def star_query(m):
    return variants.revenue_by_segment_and_vendor(
        m.fct_orders, m.stg_line_items, m.dim_customers, m.dim_products, STAR_SINCE, "vip"
    )


@query
def order_lookup(m):
    # the staged row of the order that was delivered most often
    counts = m.raw.groupBy("id").agg(F.count("*").alias("n"))
    wanted = counts.orderBy(F.col("n").desc(), "id").limit(1).select("id").scalar()
    return m.once("stg_orders").where(F.col("order_id") == wanted).select(
        "order_id", "payment_status", "fulfillment_status", "synced_at"
    )


# --- nested data -----------------------------------------------------------------

def _line_fields():
    return {
        "line_item_id": F.col("item.id"), "product_id": F.col("item.product_id"),
        "product_title": F.col("item.title"), "quantity": F.col("item.quantity").cast("long"),
    }


def _sync_key():
    return {"order_id": F.col("id"), "_daton_batch_id": F.col("_daton_batch_id")}


@query
def explode_line_items(m):
    return nested.flatten(m.raw, "line_items", _sync_key(), _line_fields())


@query
def explode_outer_line_items(m):
    return nested.flatten(m.raw, "line_items", _sync_key(), _line_fields(), keep_childless=True)


@query
def explode_fulfillments(m):
    return staging.typed_shipments(m.raw).select(
        "order_id", "_daton_batch_id", "fulfillment_id", "fulfilled_at", "fulfillment_updated_at",
        "shipping_carrier", "fulfillment_status", "shipment_status",
    )


@query
def flatten_generic(m):
    return nested.flatten(
        m.raw, "customer", _sync_key(), {"customer_id": F.col("item.id")}, keep_childless=True
    )


@query
def array_length(m):
    return m.raw.select(
        F.col("id").alias("order_id"), "_daton_batch_id",
        nested.array_length("line_items").alias("n_lines"),
        nested.array_length("fulfillments").alias("n_fulfillments"),
    )


@query
def rejoin_children(m):
    return nested.rejoin_children(m.once("stg_orders"), m.once("stg_line_items"), m.once("stg_fulfillments"))


@query
def rejoined_totals(m):
    return nested.rejoined_totals(m.once("stg_orders"), m.once("stg_line_items"), m.once("stg_fulfillments"))


# --- deduplication ---------------------------------------------------------------

@query
def dedup_latest_order(m):
    return staging.latest_orders(m.raw).select(
        "order_id", "payment_status", "total_amount", "synced_at", "_daton_batch_id"
    )


@query
def bucketed_latest_order(m):
    # the feed in three deliveries, the first two compacted, by the buckets that each was stored in
    database = "versions_" + uuid.uuid4().hex[:12]
    # a bucket is sorted by one task, so there are as many as shuffles start with, in proportion to the input
    kept = VersionStore(m.spark, database, "orders", buckets=max(8, shuffle_partitions(m.spark)))
    first, second = _two_loads(m)
    late = F.col("_daton_batch_id") == "b0"
    for rows in (first, second.where(~late)):
        kept.append(rows)
    kept.compact()
    kept.append(second.where(late))
    latest = kept.latest("order_id", staging.ORDER_RECENCY, staging.typed_orders)
    # stored as it is read, since the buckets go
    latest = store(latest.select("order_id", "payment_status", "total_amount", "synced_at", "_daton_batch_id"), "bucketed")
    m.spark.sql(f"DROP DATABASE {database} CASCADE")
    return latest


@query
def dedup_composite_key(m):
    latest = dedup.latest_per_key(
        staging.typed_lines(m.raw), ["order_id", "line_item_id"], staging.line_recency()
    )
    return latest.select("order_id", "line_item_id", "synced_at", "product_id", "quantity", "unit_price")


@query
def dedup_fulfillment(m):
    latest = dedup.latest_per_key(
        staging.typed_shipments(m.raw), ["fulfillment_id"], staging.shipment_recency()
    )
    return latest.select("fulfillment_id", "order_id", "fulfillment_updated_at", "shipment_status")


@query
def dedup_distinct(m):
    return dedup.distinct_rows(
        staging.typed_orders(m.raw).select("order_id", "payment_status", "total_amount")
    )


@query
def dedup_group_max(m):
    return dedup.greatest_per_column(
        staging.typed_orders(m.raw), "order_id",
        {"payment_status": "payment_status", "total_amount": "total_amount", "synced_at": "latest_sync"},
    )


@query
def dedup_max_join(m):
    rows = staging.typed_orders(m.raw).select("order_id", "synced_at", "payment_status", "_daton_batch_id")
    return dedup.join_to_latest(rows, "order_id", "synced_at")


@query
def dedup_qualify(m):
    latest = dedup.latest_per_key(
        staging.typed_orders(m.raw), ["order_id"], [F.col("synced_at").desc(), F.col("_daton_batch_id").desc()]
    )
    return latest.select("order_id", "payment_status", "synced_at")


@query
def dedup_debug_rank(m):
    hot = win.hot_groups(m.raw, {"order_id": F.col("id")})
    ranked = dedup.rank_versions(
        staging.typed_orders(m.raw), ["order_id"], staging.order_recency(), "debug_row_num", hot
    )
    return ranked.select("order_id", "synced_at", "debug_row_num")


@query
def duplicate_report(m):
    counted = dedup.duplicate_counts(m.raw.select(F.col("id").alias("order_id")), "order_id")
    return counted.orderBy(F.col("duplicate_count").desc(), "order_id").limit(20)


@query
def sync_history(m):
    return dedup.sync_history(m.raw, top=10)


@query
def duplicate_rows(m):
    rows = staging.typed_orders(m.raw).select("order_id", "synced_at", "payment_status")
    return dedup.rows_of_duplicates(rows, "order_id").orderBy(F.col("order_id").asc(), F.col("synced_at").desc())


@query
def dedup_rowcounts(m):
    return profile.rowcounts({"raw": (m.raw, "id"), "staging": (m.once("stg_orders"), "order_id")})


@query
def dedup_revenue_compare(m):
    return profile.revenue_totals({"raw": (m.raw, "total_price"), "staging": (m.once("stg_orders"), "total_amount")})


@query
def dedup_monitor(m):
    def elements(leaf):
        return m.raw.agg(F.sum(F.coalesce(F.size(leaf), F.lit(0))).alias("raw_rows"))

    return profile.dedup_rates({
        "orders": (m.raw.agg(F.count("*").alias("raw_rows")), m.once("stg_orders")),
        "line_items": (elements("line_items.quantity"), m.once("stg_line_items")),
        "fulfillments": (elements("fulfillments.status"), m.once("stg_fulfillments")),
    })


# --- window functions ----------------------------------------------------------------

def _metrics(m, *columns, hot_rows=None):
    return staging.order_metrics(m.raw, hot_rows).select("order_id", *columns)


@query
def customer_order_sequence(m):
    return _metrics(m, "customer_order_sequence")


@query
def previous_order(m):
    return _metrics(m, "previous_order_at", "days_since_previous_order")


@query
def running_total(m):
    return _metrics(m, "customer_running_total")


@query
def partition_totals(m):
    return _metrics(m, "customer_total_orders", "customer_lifetime_value")


@query
def is_first_order(m):
    return _metrics(m, "is_first_order")


@query
def daily_sequence(m):
    return _metrics(m, "daily_order_sequence")


@query
def customer_windows_split(m):
    # the same metrics with every group above five rows taken through the chunked way
    return staging.order_metrics(m.raw, hot_rows=5)


@query
def line_windows_split(m):
    return staging.stg_line_items(m.raw, hot_rows=4, only=("order_id", "line_item_id")).select(
        "order_id", "line_item_id", "line_item_sequence", "order_line_item_count",
        "order_total_quantity", "line_share_of_order",
    )


@query
def line_sequence(m):
    return staging.stg_line_items(m.raw).select("order_id", "line_item_id", "line_item_sequence")


@query
def line_share(m):
    return staging.stg_line_items(m.raw).select(
        "order_id", "line_item_id", "line_share_of_order", "is_single_item_order"
    )


@query
def split_shipment(m):
    return staging.stg_fulfillments(m.raw).select(
        "fulfillment_id", "order_id", "fulfillment_sequence", "order_fulfillment_count", "is_split_shipment"
    )


@query
def hours_to_fulfill(m):
    return staging.stg_fulfillments(m.raw).select("fulfillment_id", "hours_to_fulfill", "days_to_fulfill")


def _customer_lines(m, metric):
    owners = m.stg_orders.where(F.col("customer_id").isNotNull()).select("order_id", "customer_id")
    lines = m.stg_line_items.select("order_id", "line_item_id", "order_created_at", "product_title")
    # weighed by the lines of an order, two columns of them, without the rest of the fact
    counted = mid.line_summary(m.stg_line_items).select("order_id", "line_item_count")
    hot = win.hot_groups(owners.join(counted, "order_id"), {"customer_id": F.col("customer_id")}, F.col("line_item_count"))
    order = [F.col("order_created_at").asc(), F.col("order_id").asc(), F.col("line_item_id").asc()]
    rows = win.with_group_metrics(lines.join(owners, "order_id"), ["customer_id"], order, [metric], hot)
    return rows.select("order_id", "line_item_id", "customer_id", metric.name)


@query
def first_product(m):
    return _customer_lines(m, win.first_value("product_title", "first_product"))


@query
def last_product(m):
    return _customer_lines(m, win.last_value("product_title", "last_product"))


@query
def next_order(m):
    rows = store(m.once("stg_orders").select("order_id", "customer_id", "order_created_at"), "placed_orders")  # read several times
    hot = win.hot_groups(rows, {"customer_id": F.col("customer_id")})
    following = win.following("order_created_at", "next_order_at")
    return win.with_group_metrics(
        rows, ["customer_id"], staging.in_time(), [following], hot
    ).select("order_id", "next_order_at")


def _amounts(m):
    # ranks over all orders read these several times
    return store(m.once("stg_orders").select("order_id", "total_amount"), "amounts")


@query
def order_quartiles(m):
    rows = _amounts(m)
    return ranking.with_ntile(rows, [F.col("total_amount").asc(), F.col("order_id").asc()], 4, "quartile")


@query
def order_percent_rank(m):
    rows = _amounts(m)
    return ranking.with_percent_rank(rows, "total_amount", "percent_rank")


@query
def moving_avg_7(m):
    daily = m.fct_daily_revenue.select("order_date", "total_revenue")
    return marts.moving_average(daily, "order_date", "total_revenue", 7, "revenue_avg_7")


@query
def product_ranks(m):
    products = store(marts.product_sums(m.once("stg_line_items")), "product_sums")
    return marts.with_sales_ranks(products).select("product_id", "revenue_rank", "quantity_rank")


@query
def product_tier(m):
    return m.dim_products.select("product_id", "product_tier", "product_status", "days_since_last_sale")


# --- scalars -------------------------------------------------------------------

@query
def order_date_parts(m):
    return m.once("fct_orders").select(
        "order_id", "order_date", "order_year", "order_month", "order_day_of_week", "order_hour"
    )


@query
def event_time_parts(m):
    ts = F.col("ts").cast("timestamp")
    return m.table("events").select(
        "event_id", F.to_date(ts).alias("event_date"), F.year(ts).alias("event_year"),
        F.month(ts).alias("event_month"), F.dayofweek(ts).alias("event_day_of_week"),
        F.hour(ts).alias("event_hour"),
    )


@query
def safe_divide_rates(m):
    return m.once("stg_orders").select(
        "order_id",
        divide_or_null("discount_amount", "subtotal_amount").alias("discount_rate"),
        divide_or_null("tip_amount", "discount_amount").alias("tip_per_discount"),
    )


@query
def avg_days_between_orders(m):
    return m.int_customer_history.select(
        "customer_id", "avg_days_between_orders", "days_as_customer", "discount_usage_rate"
    )


# --- joins and lookups ----------------------------------------------------------

@query
def lookup_join(m):
    residence = m.table("customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("country_code"),
    )
    customers = m.int_customer_history.select("customer_id", "lifetime_revenue").join(
        residence, "customer_id", "left"
    )
    return variants.customers_with_country(customers, _countries(m))


@query
def lookup_join_ci(m):
    return variants.carriers_by_lookup(m.once("stg_fulfillments"), lookup(m.spark, "shipping_carriers"))


@query
def map_order_source(m):
    return variants.orders_by_channel(m.once("stg_orders"), lookup(m.spark, "order_source_mapping"))


@query
def map_discount_code(m):
    codes = ["BUILD25", "WELCOME10", "Platform & Seller", "UNLISTED"]
    code = F.lit(None).cast("string")
    for i, text in enumerate(codes):
        code = F.when(F.col("order_number") % 7 == i, text).otherwise(code)
    orders = m.once("stg_orders").select("order_id", "total_amount", code.alias("discount_code"))
    return variants.orders_with_discount_details(orders, lookup(m.spark, "discount_code_mapping"))


@query
def keyword_like_join(m):
    return variants.products_with_categories(m.dim_products, lookup(m.spark, "product_categories"))


@query
def exclude_list_anti(m):
    listed = m.table("customer").where("c_mktsegment = 'MACHINERY'").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@ex.com")).alias("email")
    )
    orders = m.once("stg_orders").select("order_id", "customer_email")
    return lk.not_in(orders, "customer_email", listed, "email")


@query
def first_last_order_attrs(m):
    return variants.first_last_order_attrs(m.stg_orders, m.as_of)


@query
def zero_fill_months(m):
    return dates.revenue_per_month(m.dim_dates, m.once("fct_orders"))


@query
def sum_by_month(m):
    return dates.revenue_per_sold_month(m.once("fct_orders"))


# --- aggregates --------------------------------------------------------------

@query
def fulfillment_summary(m):
    return mid.fulfillment_summary(m.once("stg_fulfillments"))


@query
def line_summary(m):
    return mid.line_summary(m.once("stg_line_items"))


@query
def acquisition_source(m):
    return m.int_customer_history.select("customer_id", "acquisition_source", "customer_email")


@query
def product_latest_attrs(m):
    # read twice: for the last times, and for the lines of these
    read = ("product_id", "order_created_at", "order_id", "line_item_id", *marts.PRODUCT_ATTRIBUTES)
    return marts.latest_product_attributes(store(m.once("stg_line_items").select(*read), "sold_lines"))


@query
def customer_sources(m):
    return variants.customer_sources(m.once("stg_orders"))


# --- models ---------------------------------------------------------------------

@query
def stg_orders(m):
    return staging.stg_orders(m.raw)


@query
def stg_line_items(m):
    return staging.stg_line_items(m.raw)


@query
def stg_fulfillments(m):
    return staging.stg_fulfillments(m.raw)


@query
def latest_version_lines(m):
    return staging.lines_of_latest_version(m.raw).select("order_id", "line_item_id", "quantity")


@query
def orders_enriched(m):
    return m.int_orders_enriched


@query
def customer_history(m):
    return m.int_customer_history


@query
def fct_orders(m):
    return marts.fct_orders(m.int_orders_enriched)


@query
def daily_revenue(m):
    return marts.newest_first(marts.fct_daily_revenue(m.once("fct_orders")))


@query
def monthly_customers(m):
    # exact counts beside those from daily sketches, which may be off by three standard errors
    month = ["order_year", "order_month"]
    fact = store(m.once("fct_orders").select("customer_id", "is_canceled", *marts.DAY), "dated_customers")  # read twice
    exact = marts.kept_orders(fact).groupBy(*month).agg(F.count_distinct("customer_id").alias("unique_customers"))
    sketches = store(marts.daily_customer_sketches(fact), "sketches")
    both = exact.join(marts.customers_per(sketches, *month, name="estimate"), month)
    allowed = 3 * 1.04 / (1 << marts.SKETCH_CELLS) ** 0.5 * F.col("unique_customers") + 1
    return both.select(*month, "unique_customers", (F.abs(F.col("estimate") - F.col("unique_customers")) <= allowed).alias("is_close"))


@query
def dim_customers(m):
    # the build time is the clock's and no part of the comparison
    return marts.dim_customers(m.int_customer_history).drop("updated_at")


@query
def dim_products(m):
    return marts.dim_products(m.stg_line_items, m.as_of).drop("updated_at")


@query
def dim_dates(m):
    return m.dim_dates


@query
def date_spine(m):
    return dates.spine_over(m.once("stg_orders"), "order_created_at")


@query
def daily_source_mix(m):
    return variants.daily_source_mix(m.once("fct_orders"))


@query
def customer_status_mix(m):
    return variants.customer_status_mix(m.stg_orders, m.as_of)


@query
def product_discount_rate(m):
    return variants.product_discount_rate(m.once("stg_line_items"))


@query
def fct_line_items(m):
    return marts.fct_line_items(m.once("stg_line_items"))


# --- changes over time ---------------------------------------------------------

@query
def incremental_equals_full(m):
    # what came up to a sync time is in the table, the rest arrives: the result is the full rebuild
    versions = staging.typed_orders(m.raw)
    early = F.col("synced_at") <= F.lit(INCREMENT_AT).cast("timestamp")
    kept = store(dedup.latest_per_key(versions.where(early), ["order_id"], staging.order_recency()), "kept")
    now = dedup.upsert_latest(kept, versions.where(~early), ["order_id"], staging.order_recency())
    return now.select("order_id", "payment_status", "total_amount", "synced_at", "_daton_batch_id")


def _two_loads(m):
    """The feed in two deliveries: the second has later versions, and every version of some orders."""
    early = from_epoch_millis("_daton_batch_runtime") <= F.lit(INCREMENT_AT).cast("timestamp")
    first = early & (F.col("order_number").cast("long") % 7 != 3)
    return m.raw.where(first), m.raw.where(~first)


def _incremental(m):
    if not hasattr(m, "increment"):
        build = IncrementalBuild(m.spark, new_folder(m.spark, "increment"), buckets=8)
        for rows in _two_loads(m):
            build.land(rows)
            build.run()
        m.increment = build
    return m.increment


@query
def incremental_orders(m):
    return _incremental(m).fct_orders()


@query
def incremental_daily_revenue(m):
    return marts.newest_first(_incremental(m).fct_daily_revenue())


@query
def incremental_customers(m):
    return _incremental(m).dim_customers(m.as_of).drop("updated_at")


@query
def orders_scd2(m):
    return changes.order_versions(m.raw)


def _merged(m, **mode):
    # later versions first for some orders, so that their earlier ones come late
    snapshot = OrderSnapshot(m.spark, new_folder(m.spark, "snapshot"), buckets=8, **mode)
    first, second = _two_loads(m)
    late = F.col("_daton_batch_id") == "b0"
    for rows in (first, second.where(~late), second.where(late)):
        snapshot.merge(rows)
    return snapshot.rows()


@query
def orders_snapshot(m):
    return _merged(m)


@query
def orders_current_state(m):
    return _merged(m, history=False).drop("valid_to", "is_current")


@query
def surrogate_keys(m):
    return m.once("stg_line_items").select(
        "order_id", "line_item_id", changes.surrogate_key("order_id", "line_item_id").alias("line_key")
    )


@query
def stream_ingest(m):
    root = new_folder(m.spark, "stream")
    files.write_jsonl(m.raw, f"{root}/in")
    streaming.ingest(m.spark, f"{root}/in", f"{root}/raw", f"{root}/progress")
    landed = streaming.landed(m.spark, f"{root}/raw")
    return staging.latest_orders(landed).select(
        "order_id", "payment_status", "total_amount", "synced_at", "_daton_batch_id"
    )


def _followed(m):
    """The feed in two deliveries to a folder that a stream reads, each an increment of the build."""
    if not hasattr(m, "followed"):
        root = new_folder(m.spark, "follow")
        build = IncrementalBuild(m.spark, f"{root}/build", buckets=8)
        for rows in _two_loads(m):
            files.write_jsonl(rows, f"{root}/in", mode="append")
            streaming.follow(m.spark, f"{root}/in", build).awaitTermination()
        m.followed = build
    return m.followed


@query
def streamed_orders(m):
    return _followed(m).fct_orders()


@query
def streamed_daily_revenue(m):
    return marts.newest_first(_followed(m).fct_daily_revenue())


@query
def streamed_customers(m):
    return _followed(m).dim_customers(m.as_of).drop("updated_at")


# --- tables, views and files ------------------------------------------------------

def _new_database(m):
    database = f"catalog_{uuid.uuid4().hex}"
    tables.ensure_database(m.spark, database)
    return database


@query
def replaced_load(m):
    # a load replaces the one before it whole, and says how many rows it has written
    source, database = tables.Source("orders"), _new_database(m)
    given = {"raw_schema": database}
    tables.save_table(m.raw.where("test = 'true'"), source.name(given))
    written = tables.save_table(m.raw, source.name(given))
    read = store(source.read(m.spark, given).select(
        F.col("id").alias("order_id"), "_daton_batch_id", "financial_status", F.lit(written).alias("loaded_rows")), "loaded")
    m.spark.sql(f"DROP DATABASE {database} CASCADE")
    return read


@query
def replaced_lookup(m):
    # codes keep their zeros under the given types; the second load has a column more
    path, database = new_folder(m.spark, "codes"), _new_database(m)
    name = f"{database}.codes"
    _countries(m).withColumn("country_code", F.lpad("country_code", 4, "0")).write.option("header", True).csv(path)
    read = files.read_lookup(m.spark, path, S.COUNTRY_CODES)
    tables.replace_lookup(read.drop("region").limit(1), name)
    tables.replace_lookup(read, name)
    found = store(m.spark.table(name), "codes")
    m.spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


@query
def exported_csv(m):
    # types are detected when the file is read back
    path = new_folder(m.spark, "export")
    tables.export_csv(m.once("fct_orders").select("order_id", "order_created_at", "total_amount", "is_canceled", "referring_site"), path)
    return files.read_lookup(m.spark, path)


@query
def orders_view(m):
    name = f"orders_{uuid.uuid4().hex}"
    tables.save_view(m.once("fct_orders"), name)
    return m.spark.sql(f"SELECT order_size_bucket, count(*) AS n_orders, sum(total_amount) AS revenue FROM {name} GROUP BY 1")


@query
def required_customer(m):
    known = m.raw.where(F.size("customer") > 0)
    return known.select(
        F.col("id").alias("order_id"), "_daton_batch_id", required_first_element("customer")["id"].alias("customer_id"))


@query
def times_of_rows(m):
    # times from text, and the time at which the dimension was made
    age = F.timestamp_diff("HOUR", "updated_at", F.current_timestamp())  # the dimension was made by this session
    stamped = m.dim_customers.select("customer_id", age.between(0, 47).alias("is_stamped"))
    orders = staging.typed_orders(m.raw).select("order_id", "customer_id", "order_created_at", "order_processed_at", "_daton_batch_id")
    return orders.join(stamped, "customer_id", "inner")


# --- data checks -----------------------------------------------------------------

@query
def check_unique(m):
    return checks.unique(m.once("fct_orders"), "customer_id")


@query
def check_not_null(m):
    return checks.not_null(m.once("stg_orders"), "customer_id").select("order_id")


@query
def check_not_null_where(m):
    return checks.not_null(m.once("fct_orders").where("is_canceled = false"), "customer_id").select("order_id")


@query
def check_accepted_values(m):
    rows = checks.accepted_values(m.once("stg_orders"), "payment_status", ("paid", "pending", "authorized", "voided"))
    return rows.select("order_id", "payment_status")


@query
def check_relationships(m):
    rows = checks.relationships(m.once("stg_line_items"), "order_id", m.once("stg_orders"), "order_id")
    return rows.select("order_id", "line_item_id")


@query
def check_customers_have_orders(m):
    customers = m.table("customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    return checks.without_children(customers, m.once("fct_orders"), "customer_id")


@query
def check_no_orders_lost(m):
    return checks.distinct_source_lost(m.raw, "id", m.once("stg_orders"))


@query
def check_positive_total(m):
    return checks.expression(m.once("fct_orders"), "total_amount >= 0").select("order_id", "total_amount")


@query
def check_discount_le_subtotal(m):
    broken = checks.expression(m.once("fct_orders"), "discount_amount <= subtotal_amount")
    return broken.select("order_id", "subtotal_amount", "discount_amount")


@query
def check_expression(m):
    return checks.expression(m.once("fct_orders"), "discount_rate < 0.1221 OR is_canceled").select("order_id", "discount_rate")


@query
def check_freshness(m):
    return checks.freshness(m.table("events"), F.col("ts").cast("timestamp"), EVENTS_AS_OF, 24, 48)


@query
def check_recency(m):
    return checks.recency(m.table("events"), "ts", "DAY", 1, EVENTS_AS_OF)


@query
def check_equal_rowcount(m):
    return checks.equal_rowcount(m.raw, m.once("stg_orders"))


@query
def check_fewer_rows(m):
    return checks.fewer_rows(m.raw, m.once("stg_orders"))


@query
def check_at_least_one(m):
    return checks.at_least_one(m.once("stg_orders").where("payment_status = 'authorized'"), "order_closed_at")


@query
def check_between(m):
    return checks.between(m.once("fct_orders"), "total_amount", 10, 400).select("order_id", "total_amount")


@query
def check_length(m):
    return checks.length_between(m.once("stg_orders"), "customer_email", 5, 10).select("order_id", "customer_email")


@query
def check_regex(m):
    pattern = r"^c[0-8]+@[a-z]+\.com$"
    return checks.matches(m.once("stg_orders"), "customer_email", pattern).select("order_id", "customer_email")


@query
def check_row_count(m):
    return checks.row_count_between(m.once("stg_orders"), 1, 100)


@query
def check_distinct_count(m):
    return checks.distinct_count_is(m.once("stg_orders"), "payment_status", 5)


@query
def check_whole_tables(m):
    checks = on_whole_tables(f"{m.as_of} 00:00:00")
    report = run_suite(checks, m.tables(checks))
    return report.select("check_name", "table_name", "severity", "failures", "status")


@query
def check_metadata(m):
    return run_suite(FURTHER, m.tables(FURTHER)).select("check_name", "table_name", "severity", "description", "owner", "failures", "status")


@query
def incremental_checks(m):
    # kept over two increments: the second refresh reads what the second increment has replaced
    build = IncrementalBuild(m.spark, new_folder(m.spark, "checked"), buckets=8)
    kept = build.checks(buckets=16)
    for rows in _two_loads(m):
        build.land(rows)
        build.run()
        kept.refresh()
    return kept.report().select("check_name", "table_name", "column_name", "severity", "failures", "status")


@query
def check_suite(m):
    return m.check().select("check_name", "table_name", "column_name", "severity", "failures", "status")
