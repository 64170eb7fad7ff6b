"""Order and daily-revenue facts, customer and product dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import segments
from ledgerloom.functions.scalars import as_of_date, calendar_days, divide_or_null
from ledgerloom.operators.lookup import broadcast_if_small
from ledgerloom.operators.ranking import with_ranks
from ledgerloom.operators.stored import store


def _long(c: Column) -> Column:
    return c.cast("long")


def fct_orders(enriched: DataFrame) -> DataFrame:
    """The order fact: enriched orders with calendar parts of the order time."""
    made = F.col("order_created_at")
    return enriched.select(
        "order_id", "customer_id",
        F.to_date(made).alias("order_date"),
        "order_created_at",
        _long(F.year(made)).alias("order_year"),
        _long(F.month(made)).alias("order_month"),
        _long(F.dayofweek(made)).alias("order_day_of_week"),
        _long(F.hour(made)).alias("order_hour"),
        "order_name", "order_number", "subtotal_amount", "discount_amount", "tax_amount",
        "tip_amount", "total_amount", "line_items_total", "discount_rate", "line_item_count",
        "total_quantity", "fulfillment_count", "hours_to_first_fulfillment", "payment_status",
        "fulfillment_status", "is_canceled", "is_fully_delivered", "is_first_order",
        "customer_order_sequence", "customer_lifetime_value", "customer_total_orders",
        "order_source", "referring_site", "order_size_bucket", "accepts_marketing",
    )


def ordered_since(fact: DataFrame, day: str) -> DataFrame:
    """Orders from a day on. The months are compared as well: the stored fact skips those before."""
    first = F.lit(day).cast("date")
    month = F.col("order_year") * 12 + F.col("order_month")
    return fact.where((F.col("order_date") >= first) & (month >= F.year(first) * 12 + F.month(first)))


def kept_orders(fact: DataFrame) -> DataFrame:
    return fact.where(~F.col("is_canceled"))


DAY = ("order_date", "order_year", "order_month")


def daily_counts() -> dict[str, Column]:
    return {
        "order_count": F.count("*"),
        "new_customer_orders": F.count_if("is_first_order"),
        "returning_customer_orders": F.count("*") - F.count_if("is_first_order"),
    }


def daily_measures() -> dict[str, Column]:
    return {
        "total_revenue": F.sum("total_amount"),
        "gross_revenue": F.sum("subtotal_amount"),
        "total_discounts": F.sum("discount_amount"),
        "total_tax": F.sum("tax_amount"),
        "total_tips": F.sum("tip_amount"),
        "average_order_value": F.avg("total_amount"),
        "avg_items_per_order": F.avg("line_item_count"),
        "avg_units_per_order": F.avg("total_quantity"),
        "avg_hours_to_fulfill": F.avg("hours_to_first_fulfillment"),
        "unique_customers": F.count_distinct("customer_id"),
    }


def daily_rates() -> dict[str, Column]:
    return {
        "revenue_per_customer": divide_or_null("total_revenue", "unique_customers"),
        "new_customer_rate": divide_or_null("new_customer_orders", "order_count"),
        "discount_rate": divide_or_null("total_discounts", "gross_revenue"),
    }


def by_day(orders: DataFrame, day: tuple[str, ...], measures: dict[str, Column]) -> DataFrame:
    """Daily aggregates with the three rates. A stored table has no order; readers sort."""
    daily = orders.groupBy(*day).agg(*[c.alias(n) for n, c in measures.items()])
    return daily.withColumns(daily_rates())


#: log2 of the cells of a sketch; its relative standard error is 1.04 / sqrt(cells), 0.8 %.
SKETCH_CELLS = 14


def daily_customer_sketches(fact: DataFrame) -> DataFrame:
    """A mergeable sketch of each day's customers. It is as long as a day has customers, up to its cells."""
    return kept_orders(fact).groupBy(*DAY).agg(F.hll_sketch_agg("customer_id", F.lit(SKETCH_CELLS)).alias("customers"))


def customers_per(sketches: DataFrame, *period: str, name: str = "unique_customers") -> DataFrame:
    """Distinct customers of longer periods, from the sketches of their days; the fact isn't read again."""
    merged = sketches.groupBy(*period).agg(F.hll_union_agg("customers").alias("_all"))
    return merged.select(*period, F.hll_sketch_estimate("_all").alias(name))


def newest_first(daily: DataFrame) -> DataFrame:
    return daily.orderBy(F.col("order_date").desc())


def fct_daily_revenue(fact: DataFrame) -> DataFrame:
    """The daily fact over orders that were not cancelled."""
    return by_day(kept_orders(fact), DAY, {**daily_counts(), **daily_measures()})


def customer_attributes() -> list[Column]:
    """The columns that every form of the customer dimension shares, after its contact columns."""
    value, recency = F.col("value_segment"), F.col("recency_segment")
    return [
        F.to_date("most_recent_order_at").alias("most_recent_order_date"),
        F.col("days_since_last_order"),
        F.col("days_as_customer"),
        F.col("total_orders").alias("lifetime_order_count"),
        F.col("avg_days_between_orders"),
        F.col("lifetime_revenue").alias("lifetime_value"),
        F.col("average_order_value"),
        F.col("min_order_value"),
        F.col("max_order_value"),
        F.col("total_discounts_used"),
        F.col("discount_usage_rate"),
        (F.col("orders_with_marketing_consent") > 0).alias("has_marketing_consent"),
        F.col("frequency_segment"),
        recency,
        value,
        segments.rfm("recency_segment", "frequency_segment", "value_segment").alias("rfm_segment"),
        segments.customer_tier(value, F.col("frequency_segment")).alias("customer_tier"),
        segments.churn_risk(recency, value).alias("is_at_churn_risk"),
    ]


def dim_customers(history: DataFrame) -> DataFrame:
    return history.select(
        "customer_id", "customer_email", "acquisition_source",
        F.to_date("first_order_at").alias("first_order_date"),
        *customer_attributes(),
        F.current_timestamp().alias("updated_at"),
    )


PRODUCT_ATTRIBUTES = {
    "product_title": "product_title",
    "product_name": "product_name",
    "product_sku": "product_sku",
    "product_vendor": "vendor",
    "variant_title": "variant_title",
}


# Products are broadcast up to so many (a key and a time each), and joined by a shuffle beyond.
BROADCAST_PRODUCTS = 1_000_000
#: Cells that products are dealt to before such a shuffle; a row of some 20 bytes each is broadcast.
PRODUCT_CELLS = 1 << 20


def _maybe_last(sold: DataFrame, last: DataFrame) -> DataFrame:
    """Without the lines that are older than all last sales of their product's cell, so that a shuffle of lines with
    their text moves few others than those of a last time."""
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(PRODUCT_CELLS)).cast("int")
    # a product whose times are all null lets its cell through
    since = last.groupBy(cell("_product").alias("_cell")).agg(F.min("_at").alias("_since"), F.bool_or(F.col("_at").isNull()).alias("_any"))
    keyed = sold.withColumn("_of", cell("product_id"))
    late = (F.col("_of") == F.col("_cell")) & (F.col("_any") | (F.col("order_created_at") >= F.col("_since")))
    return keyed.join(F.broadcast(store(since, "cells")), late, "left_semi").drop("_of")


def latest_product_attributes(lines: DataFrame, last_sold: DataFrame | None = None) -> DataFrame:
    """Attributes of each product as last sold; an attribute that is null there stays null.

    The last time of a product is a hash aggregate of two columns (``last_sold`` has it
    already, if given). Only the few lines of that time are compared further.
    """
    sold = lines.where(F.col("product_id").isNotNull())
    if last_sold is None:
        last_sold = sold.groupBy("product_id").agg(F.max("order_created_at").alias("last_sold_at"))
    last = last_sold.select(F.col("product_id").alias("_product"), F.col("last_sold_at").alias("_at"))
    if last.limit(BROADCAST_PRODUCTS + 1).count() > BROADCAST_PRODUCTS:
        sold = _maybe_last(sold, last)
    at_last = sold.join(
        broadcast_if_small(last, BROADCAST_PRODUCTS),
        (F.col("product_id") == F.col("_product")) & F.col("order_created_at").eqNullSafe(F.col("_at")), "inner")
    attributes = F.struct(*[F.col(c).alias(a) for c, a in PRODUCT_ATTRIBUTES.items()])
    latest = at_last.groupBy("product_id").agg(F.max_by(attributes, F.struct("order_id", "line_item_id")).alias("_latest"))
    return latest.select("product_id", "_latest.*")


def product_sums(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.avg("quantity").alias("avg_quantity_per_order"),
        F.sum("line_total_before_discount").alias("total_revenue"),
        F.sum("line_discount_amount").alias("total_discounts"),
        F.avg("unit_price").alias("average_selling_price"),
        F.min("order_created_at").alias("first_sold_at"),
        F.max("order_created_at").alias("last_sold_at"),
    )


def with_sales_ranks(products: DataFrame) -> DataFrame:
    """Ranks by revenue and by units. Revenue ties at six digits: the noise of summing
    doubles depends on the order of the rows and must not decide a rank."""
    rounded = products.withColumn("_revenue", F.round("total_revenue", 6))
    ranks = {"revenue_rank": "_revenue", "quantity_rank": "total_quantity_sold"}
    return with_ranks(rounded, ranks).drop("_revenue")


def dim_products(lines: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """One row per product with sales sums, ranks, tier and status.

    Lines of test and cancelled orders count, as staged lines are not filtered by either.
    """
    today = as_of_date(as_of)
    sums = store(product_sums(lines), "product_sums")
    products = with_sales_ranks(sums).join(latest_product_attributes(lines, sums), "product_id", "inner")
    idle = calendar_days("last_sold_at", today)
    return products.select(
        "product_id", "product_title", "product_name", "product_sku", "vendor", "variant_title",
        "order_count", "total_quantity_sold", "total_revenue", "total_discounts",
        "avg_quantity_per_order", "average_selling_price",
        divide_or_null("total_revenue", "total_quantity_sold").alias("revenue_per_unit"),
        F.to_date("first_sold_at").alias("first_sold_date"),
        F.to_date("last_sold_at").alias("last_sold_date"),
        idle.alias("days_since_last_sale"),
        "revenue_rank", "quantity_rank",
        segments.product_tier(F.col("revenue_rank")).alias("product_tier"),
        segments.product_status(idle, calendar_days("first_sold_at", today)).alias("product_status"),
        F.current_timestamp().alias("updated_at"),
    )


def fct_line_items(lines: DataFrame) -> DataFrame:
    return lines.select(
        "line_item_id", "order_id", "product_id", "quantity", "unit_price",
        F.col("line_total_before_discount").alias("line_total"),
    )


def moving_average(daily: DataFrame, day: str, value: str, days: int, name: str) -> DataFrame:
    """Average over the row and the ``days - 1`` before it, on a table of one row per day.

    Its one window group holds calendar days, not orders.
    """
    span = Window.orderBy(day).rowsBetween(1 - days, Window.currentRow)
    return daily.select("*", F.avg(value).over(span).alias(name))
