"""Orders beside summaries of their children, and customers summarised over their orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import segments
from ledgerloom.functions.scalars import as_of_date, calendar_days, divide_or_null, whole_hours

KEPT_ORDER_COLUMNS = (
    "order_id", "customer_id", "order_name", "order_number", "order_created_at",
    "order_processed_at", "subtotal_amount", "discount_amount", "tax_amount", "total_amount",
    "tip_amount", "payment_status", "fulfillment_status", "cancellation_reason", "order_source",
    "referring_site", "accepts_marketing", "is_first_order", "customer_order_sequence",
    "customer_lifetime_value", "customer_total_orders",
)


def line_summary(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.count("*").alias("line_item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total_before_discount").alias("line_items_total"),
    )


def fulfillment_summary(shipments: DataFrame) -> DataFrame:
    return shipments.groupBy("order_id").agg(
        F.min("fulfilled_at").alias("first_fulfilled_at"),
        F.max("fulfilled_at").alias("last_fulfilled_at"),
        F.count("*").alias("fulfillment_count"),
        F.bool_or("is_delivered").alias("is_fully_delivered"),
    )


def orders_enriched(orders: DataFrame, lines: DataFrame, shipments: DataFrame) -> DataFrame:
    """One row per order. Children are summarised before the join, so no row multiplies.

    ``line_items_total`` is the sum over the lines, and ``is_fully_delivered`` means that
    any shipment has been delivered.
    """
    joined = (
        orders.select(*KEPT_ORDER_COLUMNS)
        .join(line_summary(lines), "order_id", "left")
        .join(fulfillment_summary(shipments), "order_id", "left")
    )
    zero = F.lit(0)
    return joined.select(
        *KEPT_ORDER_COLUMNS,
        F.coalesce("line_item_count", zero).alias("line_item_count"),
        F.coalesce("total_quantity", zero).alias("total_quantity"),
        F.coalesce("line_items_total", F.lit(0.0)).alias("line_items_total"),
        "first_fulfilled_at",
        "last_fulfilled_at",
        F.coalesce("fulfillment_count", zero).alias("fulfillment_count"),
        F.coalesce("is_fully_delivered", F.lit(False)).alias("is_fully_delivered"),
        whole_hours("order_created_at", "first_fulfilled_at").alias("hours_to_first_fulfillment"),
        F.col("cancellation_reason").isNotNull().alias("is_canceled"),
        segments.order_size(F.col("total_amount")).alias("order_size_bucket"),
        divide_or_null("discount_amount", "subtotal_amount").alias("discount_rate"),
    )


def customer_sums() -> dict[str, Column]:
    return {
        "total_orders": F.count("*"),
        "lifetime_revenue": F.sum("total_amount"),
        "average_order_value": F.avg("total_amount"),
        "min_order_value": F.min("total_amount"),
        "max_order_value": F.max("total_amount"),
        "first_order_at": F.min("order_created_at"),
        "most_recent_order_at": F.max("order_created_at"),
        "orders_with_marketing_consent": F.count_if("accepts_marketing"),
        "orders_with_discount": F.count_if(F.col("discount_amount") > 0),
        "total_discounts_used": F.sum("discount_amount"),
    }


def summarise_customers(orders: DataFrame, sums: dict[str, Column]) -> DataFrame:
    known = orders.where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(*[c.alias(n) for n, c in sums.items()])


def customer_age(as_of: dt.date | str | None) -> dict[str, Column]:
    today = as_of_date(as_of)
    return {
        "days_as_customer": calendar_days("first_order_at", today),
        "days_since_last_order": calendar_days("most_recent_order_at", today),
    }


def customer_labels() -> list[Column]:
    return [
        segments.frequency(F.col("total_orders")).alias("frequency_segment"),
        segments.recency(F.col("days_since_last_order")).alias("recency_segment"),
        segments.value(F.col("lifetime_revenue")).alias("value_segment"),
    ]


def first_and_last(orders: DataFrame) -> DataFrame:
    """Source of the first and email of the last order of each known customer.

    The staged sequence singles out two orders per customer before anything is grouped.
    """
    place = F.col("customer_order_sequence")
    at_an_end = (place == 1) | (place == F.col("customer_total_orders"))
    ends = orders.where(F.col("customer_id").isNotNull() & at_an_end)
    return ends.groupBy("customer_id").agg(
        F.min_by("order_source", place).alias("acquisition_source"),
        F.max_by("customer_email", place).alias("customer_email"),
    )


def customer_base(orders: DataFrame) -> DataFrame:
    """One row per known customer: lifetime sums, source of the first and email of the last order.

    Numbers and text are grouped apart: sums alone stay in a hash aggregate, while text
    in the same aggregate would have every order sorted.
    """
    return summarise_customers(orders, customer_sums()).join(first_and_last(orders), "customer_id", "inner")


def with_age(base: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """What depends on the reporting date, or follows from the sums: ages in days, rates, segments."""
    span = calendar_days("first_order_at", "most_recent_order_at")
    return (
        base.withColumns(customer_age(as_of))
        .withColumns({
            "avg_days_between_orders": divide_or_null(
                span, F.greatest(F.col("total_orders") - 1, F.lit(1))
            ),
            "discount_usage_rate": divide_or_null("orders_with_discount", "total_orders"),
        })
        .select("*", *customer_labels())
    )


def customer_history(orders: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """One row per known customer with lifetime sums, ages in days and the three segments."""
    return with_age(customer_base(orders), as_of)
