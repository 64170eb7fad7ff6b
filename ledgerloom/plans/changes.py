"""Orders over time: the versions that differ, and keys made of several columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import windows as win
from ledgerloom.plans.staging import typed_orders

TRACKED = ("payment_status", "fulfillment_status", "cancellation_reason", "total_amount")


ORDER_OF_VERSIONS = ("synced_at", "order_updated_at", "_daton_batch_id")


def typed_states(raw: DataFrame, tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """Every version of an order, with what places it in time and its state: the tracked columns as one struct."""
    return typed_orders(raw).select("order_id", *ORDER_OF_VERSIONS, F.struct(*tracked).alias("_state"))


def state_spans(versions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The versions that open a state, each with the time at which the next state begins as ``valid_to``."""
    order = [F.col(c).asc() for c in ORDER_OF_VERSIONS]
    beside = win.with_group_metrics(
        versions, ["order_id"], order, [win.row_number("_nth"), win.previous("_state", "_before")], hot)
    changed = beside.where((F.col("_nth") == 1) | ~F.col("_state").eqNullSafe(F.col("_before")))
    return win.with_group_metrics(
        changed.drop("_nth", "_before"), ["order_id"], order, [win.following("synced_at", "valid_to")], hot)


def order_versions(
    raw: DataFrame, tracked: tuple[str, ...] = TRACKED, hot_rows: int | None = None
) -> DataFrame:
    """One row per order and state of the tracked columns, with the time it was valid.

    A sync that changes none of them opens no new row. The last state of an order has no
    end and is current.
    """
    hot = win.hot_groups(raw, {"order_id": F.col("id").cast("string")}, limit=hot_rows)
    spans = state_spans(typed_states(raw, tracked), hot)
    return spans.select(
        "order_id", "_state.*", F.col("synced_at").alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def surrogate_key(*columns: str) -> Column:
    """A hash over several columns as text. Each part has its length before it, so that no two lists
    of values give one text; a null is written unlike any text."""
    parts = [F.col(c).cast("string") for c in columns]
    written = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("null,")) for p in parts]
    return F.sha2(F.concat(*written), 256)
