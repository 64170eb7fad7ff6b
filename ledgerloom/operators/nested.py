"""Flatten arrays of structs into child rows, and put children back beside their parents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(
    df: DataFrame,
    array: str,
    parents: Mapping[str, Column],
    fields: Mapping[str, Column],
    keep_childless: bool = False,
) -> DataFrame:
    """One row per array element. ``fields`` refer to the element as ``item.<field>``.

    Only the named struct fields reach the scan: Catalyst prunes the element type to the
    leaves selected here. A parent whose array is empty or null gives no row, or with
    ``keep_childless`` one row of null fields.
    """
    unpack = F.explode_outer if keep_childless else F.explode
    rows = df.select(*[c.alias(n) for n, c in parents.items()], unpack(array).alias("item"))
    return rows.select(*parents, *[c.alias(n) for n, c in fields.items()])


def array_length(array: str) -> Column:
    """Number of elements, null for a null array."""
    return F.when(F.col(array).isNotNull(), F.size(array)).cast("long")


def rejoin_children(orders: DataFrame, lines: DataFrame, fulfillments: DataFrame) -> DataFrame:
    """Orders beside every pair of their lines and shipments; either side may be missing.

    The product of the two child sets per order is the point of this view.
    """
    return (
        orders.select("order_id", "total_amount")
        .join(lines.select("order_id", "product_title", "quantity"), "order_id", "left")
        .join(
            fulfillments.select("order_id", "tracking_number", "shipment_status"),
            "order_id", "left",
        )
    )


def rejoined_totals(orders: DataFrame, lines: DataFrame, fulfillments: DataFrame) -> DataFrame:
    """Counts and sums over the rows of :func:`rejoin_children`, one row per order, without making those rows.

    The product of two child sets has as many rows as their sizes multiplied, a set without rows counting as one row of
    nulls; each line is in it once for every shipment, and each shipment once for every line. So the totals follow from
    one summary of either side, whatever their sizes.
    """
    by_line = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_lines"), F.sum("quantity").alias("_quantity"), F.count("product_title").alias("_titled"))
    by_shipment = fulfillments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_shipments"), F.count_if(F.col("shipment_status") == "delivered").alias("_delivered"),
        F.count("tracking_number").alias("_tracked"))
    joined = orders.select("order_id", "total_amount").join(by_line, "order_id", "left").join(by_shipment, "order_id", "left")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    a, b = F.coalesce("_lines", one), F.coalesce("_shipments", one)
    return joined.select(
        "order_id", (a * b).alias("n_rows"), (F.coalesce("_quantity", zero) * b).alias("total_quantity"),
        (F.coalesce("_titled", zero) * b).alias("titled_rows"), (F.coalesce("_delivered", zero) * a).alias("delivered_rows"),
        (F.coalesce("_tracked", zero) * a).alias("tracked_rows"), (F.col("total_amount") * (a * b)).alias("repeated_amount"))
