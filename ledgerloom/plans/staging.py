"""Staged orders, line items and shipments: typed, latest version only, with window metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import segments
from ledgerloom.functions.scalars import (
    calendar_days, divide_or_null, first_element, flag, from_epoch_millis, whole_days, whole_hours,
)
from ledgerloom.operators import windows as win
from ledgerloom.operators.dedup import latest_per_key
from ledgerloom.operators.nested import flatten
from ledgerloom.operators.stored import store

_col = F.col


def _cast(name: str, kind: str) -> Column:
    return _col(name).cast(kind)


def _sync() -> dict[str, Column]:
    return {
        "synced_at": from_epoch_millis("_daton_batch_runtime"),
        "_daton_batch_id": _col("_daton_batch_id"),
    }


def order_columns() -> dict[str, Column]:
    return {
        "order_id": _cast("id", "string"),
        "customer_id": first_element("customer")["id"].cast("string"),
        "order_name": _col("name"),
        "order_number": _cast("order_number", "long"),
        "confirmation_number": _col("confirmation_number"),
        "order_created_at": _cast("created_at", "timestamp"),
        "order_processed_at": _cast("processed_at", "timestamp"),
        "order_updated_at": _cast("updated_at", "timestamp"),
        "order_closed_at": _cast("closed_at", "timestamp"),
        "order_cancelled_at": _cast("cancelled_at", "timestamp"),
        "subtotal_amount": _cast("subtotal_price", "double"),
        "discount_amount": _cast("total_discounts", "double"),
        "tax_amount": _cast("total_tax", "double"),
        "total_amount": _cast("total_price", "double"),
        "line_items_total": _cast("total_line_items_price", "double"),
        "tip_amount": _cast("total_tip_received", "double"),
        "order_currency": _col("currency"),
        "presentment_currency": _col("presentment_currency"),
        "payment_status": F.lower("financial_status"),
        "fulfillment_status": F.lower(F.coalesce("fulfillment_status", F.lit("unfulfilled"))),
        "cancellation_reason": F.lower("cancel_reason"),
        "order_source": _col("source_name"),
        "source_identifier": _col("source_identifier"),
        "referring_site": F.coalesce("referring_site", F.lit("direct")),
        "customer_email": _col("email"),
        "customer_phone": _col("phone"),
        "is_confirmed": _cast("confirmed", "boolean"),
        "is_test_order": _cast("test", "boolean"),
        "is_tax_inclusive": _cast("taxes_included", "boolean"),
        "accepts_marketing": _cast("buyer_accepts_marketing", "boolean"),
        "order_tags": _col("tags"),
        "app_id": _cast("app_id", "string"),
        "order_token": _col("token"),
        "_daton_user_id": _col("_daton_user_id"),
        **_sync(),
    }


def line_parents() -> dict[str, Column]:
    return {
        "order_id": _cast("id", "string"),
        **_sync(),
        "order_number": _col("order_number"),
        "order_created_at": _cast("created_at", "timestamp"),
    }


def line_columns() -> dict[str, Column]:
    return {
        "line_item_id": _cast("item.id", "string"),
        "product_id": _cast("item.product_id", "string"),
        "variant_id": _cast("item.variant_id", "string"),
        "product_sku": _col("item.sku"),
        "product_title": _col("item.title"),
        "product_name": _col("item.name"),
        "variant_title": _col("item.variant_title"),
        "product_vendor": _col("item.vendor"),
        "quantity": _cast("item.quantity", "long"),
        "unit_price": _cast("item.price", "double"),
        "line_discount_amount": _cast("item.total_discount", "double"),
        "weight_grams": _cast("item.grams", "long"),
        "line_total_before_discount": _cast("item.price", "double") * _cast("item.quantity", "long"),
        "fulfillment_service": _col("item.fulfillment_service"),
        "fulfillment_status": _col("item.fulfillment_status"),
        "fulfillable_quantity": _cast("item.fulfillable_quantity", "long"),
        "requires_shipping": _cast("item.requires_shipping", "boolean"),
        "is_taxable": _cast("item.taxable", "boolean"),
        "is_gift_card": _cast("item.gift_card", "boolean"),
        "product_exists": _cast("item.product_exists", "boolean"),
        "inventory_management": _col("item.variant_inventory_management"),
        "admin_graphql_api_id": _col("item.admin_graphql_api_id"),
    }


def shipment_parents() -> dict[str, Column]:
    return {**line_parents(), "order_name": _col("name")}


def shipment_columns() -> dict[str, Column]:
    return {
        "fulfillment_id": _cast("item.id", "string"),
        "fulfillment_name": _col("item.name"),
        "fulfilled_at": _cast("item.created_at", "timestamp"),
        "fulfillment_updated_at": _cast("item.updated_at", "timestamp"),
        "shipping_carrier": _col("item.tracking_company"),
        "tracking_number": _col("item.tracking_number"),
        "tracking_url": _col("item.tracking_url"),
        "tracking_numbers_raw": _col("item.tracking_numbers"),
        "tracking_urls_raw": _col("item.tracking_urls"),
        "fulfillment_status": F.lower("item.status"),
        "shipment_status": F.lower("item.shipment_status"),
        "fulfillment_service": _col("item.service"),
        "fulfillment_location_id": _cast("item.location_id", "string"),
        "admin_graphql_api_id": _col("item.admin_graphql_api_id"),
    }


def typed_orders(raw: DataFrame) -> DataFrame:
    """Renamed and cast order fields, one row per sync version, arrays left out."""
    return raw.select(*[c.alias(n) for n, c in order_columns().items()])


def typed_lines(raw: DataFrame) -> DataFrame:
    return flatten(raw, "line_items", line_parents(), line_columns())


def typed_shipments(raw: DataFrame) -> DataFrame:
    return flatten(raw, "fulfillments", shipment_parents(), shipment_columns())


# The first three decide by time and batch. The rest settle full ties by the very columns
# that the window metrics use, so that every reading of a tie agrees on them.
ORDER_RECENCY = (
    "synced_at", "order_updated_at", "_daton_batch_id",
    "is_test_order", "order_created_at", "total_amount", "customer_id",
)
LINE_RECENCY = ("synced_at", "order_created_at", "_daton_batch_id")
SHIPMENT_RECENCY = ("fulfillment_updated_at", "synced_at", "_daton_batch_id")


def _newest(columns: tuple[str, ...]) -> list[Column]:
    return [_col(c).desc() for c in columns]


def order_recency() -> list[Column]:
    return _newest(ORDER_RECENCY)


def line_recency() -> list[Column]:
    return _newest(LINE_RECENCY)


def shipment_recency() -> list[Column]:
    return _newest(SHIPMENT_RECENCY)


def latest_orders(raw: DataFrame) -> DataFrame:
    return latest_per_key(typed_orders(raw), ["order_id"], order_recency())


def real_orders(orders: DataFrame) -> DataFrame:
    """Without test orders. Applied after deduplication: the latest version decides."""
    return orders.where(~flag(_col("is_test_order")))


def in_time() -> list[Column]:
    """Orders from first to last; the id settles equal times."""
    return [_col("order_created_at").asc(), _col("order_id").asc()]


CUSTOMER_METRICS = [
    win.row_number("customer_order_sequence"),
    win.previous("order_created_at", "previous_order_at"),
    win.running_sum("total_amount", "customer_running_total"),
    win.group_count("customer_total_orders"),
    win.group_sum("total_amount", "customer_lifetime_value"),
]


def order_metrics(raw: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Customer and day window metrics per order, on the few columns they need.

    Windowing narrow rows keeps the wide order row out of the customer and day shuffles.
    Guests (null customer) are one group, as are the orders of one day; the check on the
    raw table finds the groups too large for one task before anything is shuffled.
    """
    made = _cast("created_at", "timestamp")
    hot = win.hot_groups_together(raw, {"customer_id": order_columns()["customer_id"], "_day": F.to_date(made)}, hot_rows)

    narrow = real_orders(latest_orders(raw)).select(
        "order_id", "customer_id", "order_created_at", "total_amount"
    )
    known = win.with_group_metrics(
        narrow, ["customer_id"], in_time(), CUSTOMER_METRICS, hot["customer_id"]
    ).withColumn("_day", F.to_date("order_created_at"))
    daily = win.with_group_metrics(
        known, ["_day"], in_time(), [win.row_number("daily_order_sequence")], hot["_day"]
    )
    return daily.select(
        "order_id",
        "customer_order_sequence",
        "previous_order_at",
        calendar_days("previous_order_at", "order_created_at").alias("days_since_previous_order"),
        "customer_running_total",
        "customer_total_orders",
        "customer_lifetime_value",
        (_col("customer_order_sequence") == 1).alias("is_first_order"),
        "daily_order_sequence",
    )


# A join key that is never null, so that an order without an id keeps its row and the
# join can use the partitioning the deduplication left behind.
def _join_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), "order_id"), F.lit(""))


def stg_orders(raw: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row per real order: the latest version with customer and day metrics."""
    keyed = typed_orders(raw).withColumn("_key", _join_key())
    orders = real_orders(latest_per_key(keyed, ["_key"], order_recency()))
    metrics = order_metrics(raw, hot_rows).withColumn("_key", _join_key()).drop("order_id")
    return orders.join(metrics, "_key", "inner").drop("_key")


#: What the windows of an order's lines need of them.
LINE_WINDOWED = ("order_id", "line_item_id", "quantity", "line_total_before_discount")


def stg_line_items(raw: DataFrame, hot_rows: int | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """One row per order line over all versions, with its place and share in the order.

    Ordinary orders are shuffled once, by order: that serves the deduplication and the
    order windows alike. Orders with too many lines for one task are deduplicated on
    the full key and windowed in chunks; all lines are then deduplicated once and stored.
    ``only`` names the columns of a line that are wanted, so that no others are stored.
    """
    line_count = F.coalesce(F.size("line_items.quantity"), F.lit(0))  # one small leaf, not the array
    hot = win.hot_groups(raw, {"order_id": _cast("id", "string")}, line_count, hot_rows)
    lines = typed_lines(raw)
    key = ["order_id", "line_item_id"]
    if hot is None:
        lines = lines.repartition("order_id")
    own = [c for c in (*line_parents(), *line_columns()) if only is None or c in only]
    lines = latest_per_key(lines, key, line_recency()).select(*dict.fromkeys((*own, *LINE_WINDOWED)))
    if hot is not None:
        lines = store(lines, "lines")
    lines = win.with_group_metrics(
        lines, ["order_id"], [_col("line_item_id").asc()],
        [
            win.row_number("line_item_sequence"),
            win.group_count("order_line_item_count"),
            win.group_sum("quantity", "order_total_quantity"),
            win.group_sum("line_total_before_discount", "_order_total"),
        ],
        hot,
    )
    return lines.select(
        *own,
        "line_item_sequence", "order_line_item_count", "order_total_quantity",
        divide_or_null("line_total_before_discount", "_order_total").alias("line_share_of_order"),
        (_col("order_line_item_count") == 1).alias("is_single_item_order"),
    )


def delivery_flags() -> dict[str, Column]:
    status = _col("shipment_status")
    return {"is_delivered": flag(status == "delivered"), "is_in_transit": flag(status == "in_transit")}


def stg_fulfillments(raw: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row per shipment, with delays, place in the order, carrier and delivery flags."""
    shipment_count = F.coalesce(F.size("fulfillments.status"), F.lit(0))
    hot = win.hot_groups(raw, {"order_id": _cast("id", "string")}, shipment_count, hot_rows)
    shipments = latest_per_key(typed_shipments(raw), ["fulfillment_id"], shipment_recency())
    shipments = win.with_group_metrics(
        shipments, ["order_id"], [_col("fulfilled_at").asc(), _col("fulfillment_id").asc()],
        [win.row_number("fulfillment_sequence"), win.group_count("order_fulfillment_count")],
        hot,
    )
    return shipments.select(
        *shipment_parents(), *shipment_columns(),
        whole_hours("order_created_at", "fulfilled_at").alias("hours_to_fulfill"),
        whole_days("order_created_at", "fulfilled_at").alias("days_to_fulfill"),
        "fulfillment_sequence", "order_fulfillment_count",
        (_col("order_fulfillment_count") > 1).alias("is_split_shipment"),
        segments.carrier(_col("shipping_carrier")).alias("shipping_carrier_standardized"),
        *[c.alias(n) for n, c in delivery_flags().items()],
    )


def lines_of_latest_version(raw: DataFrame) -> DataFrame:
    """Line items of the newest version of each order only; lines removed later are gone."""
    newest = latest_per_key(
        raw, ["id"],
        [from_epoch_millis("_daton_batch_runtime").desc(),
         _cast("updated_at", "timestamp").desc(), _col("_daton_batch_id").desc()],
    )
    return typed_lines(newest)
