"""Documented variants of the models: more counts, first and last order attributes, lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import calendar_days, divide_or_null
from ledgerloom.operators.lookup import broadcast_if_small, contains_keyword, map_values
from ledgerloom.plans import intermediate as mid
from ledgerloom.plans import marts


def daily_source_mix(fact: DataFrame) -> DataFrame:
    """The daily fact with weekday, delivery and per-source counts.

    A null first-order flag counts as neither new nor returning here.
    """
    orders = marts.kept_orders(fact).withColumn("day_of_week", F.dayofweek("order_date").cast("long"))
    return marts.by_day(orders, (*marts.DAY, "day_of_week"), {
        "order_count": F.count("*"),
        "new_customer_orders": F.count_if("is_first_order"),
        "returning_customer_orders": F.count_if(~F.col("is_first_order")),
        "canceled_order_count": F.count_if("is_canceled"),
        **marts.daily_measures(),
        "fully_delivered_count": F.count_if("is_fully_delivered"),
        "web_orders": F.count_if(F.col("order_source") == "web"),
        "tiktok_orders": F.count_if(F.col("order_source") == "TikTok"),
    })


def customer_sources(orders: DataFrame) -> DataFrame:
    """The distinct sources of each known customer, sorted; empty when all are null.

    Repeats go before the shuffle, so a group is as large as its list of sources.
    """
    pairs = orders.where(F.col("customer_id").isNotNull()).select("customer_id", "order_source").distinct()
    return pairs.groupBy("customer_id").agg(F.sort_array(F.collect_list("order_source")).alias("order_sources"))


def customer_status_mix(orders: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Customer history with sources, refunds and cancellations.

    The average gap divides by orders - 1, so a single order has none.
    """
    summed = mid.summarise_customers(orders, {
        **mid.customer_sums(),
        "first_orders": F.count_if("is_first_order"),
        "refunded_orders": F.count_if(F.col("payment_status") == "refunded"),
        "canceled_orders": F.count_if(F.col("cancellation_reason").isNotNull()),
    }).join(customer_sources(orders), "customer_id", "inner")
    span = calendar_days("first_order_at", "most_recent_order_at")
    return (
        summed.withColumns(mid.customer_age(as_of))
        .withColumns({
            "avg_days_between_orders": divide_or_null(span, F.col("total_orders") - 1),
            "discount_usage_rate": divide_or_null("orders_with_discount", "total_orders"),
            "refund_rate": divide_or_null("refunded_orders", "total_orders"),
        })
        .select("*", *mid.customer_labels())
    )


def _order_at(orders: DataFrame, place: Column, **columns: str) -> DataFrame:
    """One order per known customer, picked by its place in the customer's sequence."""
    picked = orders.where(place & F.col("customer_id").isNotNull())
    return picked.select("customer_id", *[F.col(c).alias(n) for n, c in columns.items()])


def first_last_order_attrs(orders: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """The customer dimension with contact, source and referrer of the first and last order."""
    sequence = F.col("customer_order_sequence")
    last = _order_at(
        orders, sequence == F.col("customer_total_orders"), customer_email="customer_email",
        latest_order_source="order_source", latest_referring_site="referring_site",
    )
    first = _order_at(
        orders, sequence == 1,
        acquisition_source="order_source", acquisition_referrer="referring_site",
    )
    joined = (
        customer_status_mix(orders, as_of)
        .join(last, "customer_id", "left")
        .join(first, "customer_id", "left")
    )
    return joined.select(
        "customer_id", "customer_email", "latest_order_source", "latest_referring_site",
        "acquisition_source", "acquisition_referrer",
        F.to_date("first_order_at").alias("first_order_date"),
        *marts.customer_attributes(),
        "refund_rate", F.col("canceled_orders").alias("canceled_order_count"),
    )


def product_discount_rate(lines: DataFrame) -> DataFrame:
    """Discounts as a share of revenue before discounts were taken off."""
    sums = marts.product_sums(lines)
    total = F.col("total_revenue") + F.col("total_discounts")
    return sums.select(
        "product_id", "total_revenue", "total_discounts",
        divide_or_null("total_discounts", total).alias("discount_rate"),
    )


def carriers_by_lookup(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """Carrier names mapped by a case-insensitive lookup, with a type or 'Unknown'."""
    side = broadcast_if_small(carriers)
    same = F.lower(shipments["shipping_carrier"]) == F.lower(side["raw_carrier_name"])
    return shipments.join(side, same, "left").select(
        "fulfillment_id",
        F.col("shipping_carrier").alias("original_carrier"),
        F.coalesce("standardized_name", "shipping_carrier").alias("carrier"),
        F.coalesce("carrier_type", F.lit("Unknown")).alias("carrier_type"),
    )


def orders_by_channel(orders: DataFrame, mapping: DataFrame) -> DataFrame:
    """Order sources mapped to clean names and channel types."""
    return map_values(
        orders.select("order_id", "order_source"), mapping,
        (F.col("order_source"), F.col("raw_source")),
        {
            "order_source": F.coalesce("clean_source", "order_source"),
            "channel_type": F.coalesce("channel_type", F.lit("Other")),
        },
    )


def orders_with_discount_details(orders: DataFrame, mapping: DataFrame) -> DataFrame:
    """Orders with category, channel and platform flag of their discount code."""
    side = broadcast_if_small(mapping)
    joined = orders.join(side, orders["discount_code"] == side["discount_code"], "left")
    return joined.select(
        *[orders[c] for c in orders.columns],
        F.coalesce("discount_category", F.lit("Unknown")).alias("discount_category"),
        F.coalesce("discount_channel", F.lit("Unknown")).alias("discount_channel"),
        F.coalesce("is_platform_discount", F.lit(False)).alias("is_platform_discount"),
    )


def products_with_categories(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products beside every category whose keyword their title contains."""
    rows = products.select("product_id", "product_title")
    matched = contains_keyword(rows, "product_title", categories, "product_keyword")
    return matched.select(
        "product_id", "product_title",
        F.coalesce("category", F.lit("Uncategorized")).alias("category"),
        F.coalesce("subcategory", F.lit("Other")).alias("subcategory"),
    )


def customers_with_country(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers that carry a country code, with the country's name and region."""
    return map_values(
        customers, countries,
        (customers["country_code"], countries["country_code"]),
        {"country_name": F.col("country_name"), "region": F.col("region")},
    )


def revenue_by_segment_and_vendor(
    fact: DataFrame, lines: DataFrame, customers: DataFrame, products: DataFrame,
    since: str, value_segment: str,
) -> DataFrame:
    """The star query: order lines with customer and product attributes, filtered and grouped.

    The product leg needs line grain, as the order fact has no product. Both filters are
    applied to their table before any join.
    """
    # a filter on the right side of the left joins drops unmatched rows, so inner is the same
    dated = marts.ordered_since(fact, since).select("order_id", "customer_id")
    wanted = customers.where(F.col("value_segment") == value_segment).select(
        "customer_id", "value_segment", "customer_tier"
    )
    sold = lines.select("order_id", "product_id", "line_total_before_discount")
    return (
        dated.join(wanted, "customer_id", "inner")
        .join(sold, "order_id", "inner")
        .join(products.select("product_id", "vendor"), "product_id", "left")
        .groupBy("value_segment", "customer_tier", "vendor")
        .agg(
            F.sum("line_total_before_discount").alias("total_revenue"),
            F.count("order_id").alias("order_count"),
        )
    )
