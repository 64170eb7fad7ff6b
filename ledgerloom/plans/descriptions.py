"""Descriptions, grain and owner tags stored with the tables."""

from __future__ import annotations

_CORE = {"tags": "core,daily"}


def _model(description: str, grain: str, properties: dict | None = None, **columns: str) -> dict:
    return {
        "description": f"{description} Grain: one row per {grain}.",
        "columns": columns,
        "properties": {"grain": grain, **(properties or {})},
    }


MODELS: dict[str, dict] = {
    "stg_orders": _model(
        "Latest version of every real order, with customer and day metrics.", "order",
        order_id="Key of the order",
        customer_id="Customer of the order, null for guests",
        order_created_at="When the order was placed (UTC)",
        total_amount="Order total with tax, after discounts",
        payment_status="Payment state in lower case",
        fulfillment_status="Shipping state in lower case, unfulfilled when none is given",
        customer_order_sequence="Place of the order among the customer's orders, from 1",
        previous_order_at="When the customer ordered before this",
        days_since_previous_order="Calendar days since that order",
        customer_running_total="Customer's spend up to and with this order",
        customer_total_orders="Number of the customer's orders",
        customer_lifetime_value="Customer's spend over all orders",
        is_first_order="Whether this is the customer's first order",
    ),
    "stg_line_items": _model(
        "Order lines over all sync versions of their order.", "order line",
        line_item_id="Key of the line",
        order_id="Order of the line",
        quantity="Units ordered",
        unit_price="Price of one unit",
        line_total_before_discount="Units times price",
        line_item_sequence="Place of the line in its order, by id text",
        order_line_item_count="Lines of the order",
        line_share_of_order="Line total over order total, null when that is zero",
    ),
    "stg_fulfillments": _model(
        "Shipments of orders, with delays, carrier and delivery flags.", "shipment",
        fulfillment_id="Key of the shipment",
        order_id="Order of the shipment",
        fulfilled_at="When it was shipped",
        shipping_carrier="Carrier as delivered by the feed",
        shipping_carrier_standardized="Known carrier, else the feed's text",
        hours_to_fulfill="Whole hours from order to shipment",
        days_to_fulfill="Whole days from order to shipment",
        fulfillment_sequence="Place of the shipment in its order, from 1",
        is_split_shipment="Whether the order has several shipments",
        is_delivered="Whether it has arrived",
    ),
    "fct_orders": _model(
        "Order fact with money, quantity, shipping and customer measures.", "order", _CORE,
        order_id="Key of the order",
        customer_id="Key into dim_customers",
        order_date="Day of the order",
        total_amount="Order total paid",
        payment_status="Payment state",
        order_size_bucket="Size class of the order total",
    ),
    "fct_daily_revenue": _model(
        "Revenue, customers and rates per day, cancelled orders left out.", "day", _CORE,
        order_date="The day",
    ),
    "dim_customers": _model(
        "Customers with lifetime measures, segments, tier and churn flag.", "customer", _CORE,
        customer_id="Key of the customer",
        customer_tier="Tier by value and frequency",
        frequency_segment="Class by number of orders",
        recency_segment="Class by days since the last order",
        value_segment="Class by lifetime revenue",
    ),
    "dim_products": _model(
        "Products with sales measures, ranks, tier and status.", "product", _CORE,
        product_id="Key of the product",
        product_tier="Class by revenue rank",
        product_status="new, active or dormant by sale dates",
    ),
    "dim_dates": _model(
        "Calendar days with parts, names and flags.", "day", {"tags": "core"},
        date_day="The day",
        date_key="The day as yyyymmdd text",
    ),
}
