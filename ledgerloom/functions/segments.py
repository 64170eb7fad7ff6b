"""Labels and flags of orders, customers, products and carriers.

The first matching rule wins. A null falls through every comparison to the last label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import schema as S

# The limits that decide each label.
SIZE_LIMITS = (25, 100, 250)
RECENCY_DAYS = (30, 90, 180)
VALUE_LIMITS = (100, 500, 2000)
RANK_LIMITS = (10, 50, 100)
DEVELOPING_ORDERS = (2, 3)
LOYAL_ORDERS = (4, 10)
DORMANT_AFTER_DAYS = 90
NEW_WITHIN_DAYS = 30
# Text searched for in the lower-cased carrier, in this order.
CARRIERS = (("fedex", "FedEx"), ("ups", "UPS"), ("usps", "USPS"), ("dhl", "DHL"))


def _ladder(tests: Sequence[Column], labels: Sequence[str]) -> Column:
    """The label of the first true test, else the last label."""
    steps = F.lit(labels[-1])
    for test, label in reversed(list(zip(tests, labels))):
        steps = F.when(test, label).otherwise(steps)
    return steps


def order_size(total: Column) -> Column:
    return _ladder([total < x for x in SIZE_LIMITS], S.SIZE_BUCKETS)


def frequency(orders: Column) -> Column:
    tests = [orders == 1, orders.between(*DEVELOPING_ORDERS), orders.between(*LOYAL_ORDERS)]
    return _ladder(tests, S.FREQUENCY_SEGMENTS)


def recency(days_since_last: Column) -> Column:
    return _ladder([days_since_last <= d for d in RECENCY_DAYS], S.RECENCY_SEGMENTS)


def value(revenue: Column) -> Column:
    return _ladder([revenue < x for x in VALUE_LIMITS], S.VALUE_SEGMENTS)


def rfm(recency_label: str, frequency_label: str, value_label: str) -> Column:
    """The three labels joined by underscores; null if any is null."""
    return F.concat(recency_label, F.lit("_"), frequency_label, F.lit("_"), value_label)


def customer_tier(value_label: Column, frequency_label: Column) -> Column:
    tests = [
        value_label == "vip",
        (value_label == "high_value") & frequency_label.isin("loyal", "champion"),
        value_label.isin("high_value", "medium_value"),
    ]
    return _ladder(tests, S.CUSTOMER_TIERS)


def churn_risk(recency_label: Column, value_label: Column) -> Column:
    slipping = (recency_label == "at_risk") & value_label.isin("high_value", "vip")
    return F.coalesce((recency_label == "churned") | slipping, F.lit(False))


def product_tier(rank: Column) -> Column:
    return _ladder([rank <= r for r in RANK_LIMITS], S.PRODUCT_TIERS)


def product_status(days_since_last_sale: Column, days_since_first_sale: Column) -> Column:
    return (
        F.when(days_since_last_sale > DORMANT_AFTER_DAYS, "dormant")
        .when(days_since_first_sale <= NEW_WITHIN_DAYS, "new")
        .otherwise("active")
    )


def carrier(name: Column) -> Column:
    """The known carrier named in the text, else the text itself, else 'Unknown'."""
    label = F.coalesce(name, F.lit("Unknown"))
    for word, known in reversed(CARRIERS):
        label = F.when(F.lower(name).like(f"%{word}%"), known).otherwise(label)
    return label
