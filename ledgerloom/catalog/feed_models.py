"""The models over the feed of one table folder, built once per session and data state."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.stored import store
from ledgerloom.plans import intermediate, marts
from ledgerloom.plans.build import Models
from ledgerloom.session import scale_shuffles, use_settings
from ledgerloom.sources import feed


#: What the catalog's queries and checks read of a staged model that is stored for several readings. The queries named
#: after the staged models have all columns of them.
READ = {
    "stg_orders": (*intermediate.KEPT_ORDER_COLUMNS, "customer_email", "order_closed_at", "synced_at"),
    "stg_line_items": (
        "order_id", "line_item_id", "order_created_at", "product_id", *(c for c in marts.PRODUCT_ATTRIBUTES),
        "quantity", "unit_price", "line_discount_amount", "line_total_before_discount",
    ),
    "stg_fulfillments": (
        "fulfillment_id", "order_id", "fulfilled_at", "shipping_carrier", "tracking_number", "shipment_status", "is_delivered",
    ),
}


def store_read(model: DataFrame, name: str) -> DataFrame:
    return store(model.select(*READ[name]) if name in READ else model, name)


class FeedModels(Models):
    """Models over the landed feed, with the flat tables at hand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        super().__init__(None, as_of=feed.AS_OF, keep=store_read)
        del self.raw

    @cached_property
    def raw(self) -> DataFrame:
        """Landed when a query first reads it; some read the flat tables alone."""
        return feed.land_raw_orders(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return feed.table(self.spark, self.folder, name)


_FEED_TABLES = ("orders", "lineitem", "part")
_models: dict[tuple, FeedModels] = {}


def models_for(spark: SparkSession, folder: str) -> FeedModels:
    """The session's models of a folder; files that have changed since give new ones."""
    use_settings(spark)
    folder = folder.rstrip("/")
    place = (spark.sparkContext.applicationId, folder)
    stamp = feed.tables_stamp(spark, folder, _FEED_TABLES)
    scale_shuffles(spark, stamp[1])
    known = _models.get(place)
    if known is None or known[0] != stamp:
        _models[place] = known = (stamp, FeedModels(spark, folder))
    return known[1]


# Integers and flags that may be null. Data frames of different engines hold those in
# different types, so they are compared as doubles and as text.
NULLABLE_NUMBERS = {
    "days_since_previous_order", "hours_to_first_fulfillment", "n_fulfillments", "quantity",
    "weight_grams", "fulfillable_quantity",
}
NULLABLE_FLAGS = {
    "is_test_order", "is_confirmed", "is_tax_inclusive", "requires_shipping", "is_taxable",
    "is_gift_card", "product_exists",
}


def comparable(df: DataFrame) -> DataFrame:
    """Values in a form that other engines print alike: rounded doubles, longs, times as text."""
    out = []
    for f in df.schema.fields:
        column, kind = F.col(f"`{f.name}`"), f.dataType
        if f.name in NULLABLE_NUMBERS:
            column = column.cast("double")
        elif f.name in NULLABLE_FLAGS:
            column = column.cast("string")
        elif isinstance(kind, T.DoubleType):
            # by way of a decimal, so that engines agree on exact halves
            column = F.round(column.cast("decimal(38,9)"), 6).cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            column = column.cast("long")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.ArrayType):
            column = F.concat_ws(",", column)
        out.append(column.alias(f.name))
    return df.select(*out)
