"""Raw order schema, lookup schemas and the fixed vocabularies of the models.

Every raw scalar is a string: the feed quotes its values and the staging layer
does the casts, so a bad value fails there and not in JSON inference.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _array_of(*names: str) -> T.ArrayType:
    return T.ArrayType(T.StructType(_strings(*names)))


LINE_ITEM_FIELDS = (
    "id", "product_id", "variant_id", "sku", "title", "name", "variant_title", "vendor",
    "quantity", "price", "total_discount", "grams", "fulfillment_service", "fulfillment_status",
    "fulfillable_quantity", "requires_shipping", "taxable", "gift_card", "product_exists",
    "variant_inventory_management", "admin_graphql_api_id",
)

FULFILLMENT_FIELDS = (
    "id", "name", "created_at", "updated_at", "tracking_company", "tracking_number",
    "tracking_url", "tracking_numbers", "tracking_urls", "status", "shipment_status",
    "service", "location_id", "admin_graphql_api_id",
)

RAW_ORDERS = T.StructType(
    [T.StructField("id", T.StringType(), False)]
    + _strings(
        "name", "order_number", "confirmation_number",
        "created_at", "processed_at", "updated_at", "closed_at", "cancelled_at",
        "subtotal_price", "total_discounts", "total_tax", "total_price",
        "total_line_items_price", "total_tip_received",
        "currency", "presentment_currency",
        "financial_status", "fulfillment_status", "cancel_reason",
        "source_name", "source_identifier", "referring_site",
        "email", "phone", "tags", "token", "app_id",
        "confirmed", "test", "taxes_included", "buyer_accepts_marketing",
        "_daton_user_id", "_daton_batch_id", "_daton_batch_runtime",
    )
    + [
        T.StructField("customer", _array_of("id")),
        T.StructField("shipping_address", _array_of("country_code")),
        T.StructField("line_items", _array_of(*LINE_ITEM_FIELDS)),
        T.StructField("fulfillments", _array_of(*FULFILLMENT_FIELDS)),
    ]
)

# Lookup (CSV) schemas. Codes stay text so that leading zeros survive.
COUNTRY_CODES = T.StructType(_strings("country_code", "country_name", "region"))
SHIPPING_CARRIERS = T.StructType(_strings("raw_carrier_name", "standardized_name", "carrier_type"))
EXCLUDED_EMAILS = T.StructType(_strings("email"))
ORDER_SOURCE_MAPPING = T.StructType(_strings("raw_source", "clean_source", "channel_type"))
DISCOUNT_CODE_MAPPING = T.StructType(
    _strings("discount_code", "discount_category", "discount_channel")
    + [T.StructField("is_platform_discount", T.BooleanType())]
)
PRODUCT_CATEGORIES = T.StructType(_strings("product_keyword", "category", "subcategory"))
ZIP_CODES = T.StructType(
    [T.StructField("zip_code", T.StringType()), T.StructField("population", T.IntegerType())]
)

# Vocabularies that results must match.
SIZE_BUCKETS = ("small", "medium", "large", "enterprise")
FREQUENCY_SEGMENTS = ("one_time", "developing", "loyal", "champion")
RECENCY_SEGMENTS = ("active", "cooling", "at_risk", "churned")
VALUE_SEGMENTS = ("low_value", "medium_value", "high_value", "vip")
CUSTOMER_TIERS = ("platinum", "gold", "silver", "bronze")
PRODUCT_TIERS = ("top_10", "top_50", "top_100", "other")
PRODUCT_STATUSES = ("new", "active", "dormant")
STAGED_PAYMENT_STATUSES = (
    "paid", "pending", "refunded", "partially_refunded", "voided", "authorized",
)
FACT_PAYMENT_STATUSES = (
    "paid", "pending", "refunded", "voided", "partially_refunded", "authorized", "partially_paid",
)
FULFILLMENT_STATUSES = ("fulfilled", "unfulfilled", "partial", "restocked")
FIXED_HOLIDAYS = ("01-01", "07-04", "12-25")
FISCAL_YEAR_FIRST_MONTH = 2
