"""Small lookup tables of the registered queries, as text, one table each.

Own test data, made for these queries: rows of every kind that the joins tell apart. One
order source of the feed has no row, so that the default for others is met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schema as S

ROWS = {
    # every spelling of the feed in another case, one with two services, some that no shipment has
    "shipping_carriers": [
        ("fedex GROUND", "Federal Parcel", "Economy"),
        ("ups next day air", "Brown Vans", "Express"),
        ("USPS", "Letter Post", "Standard"),
        ("Dhl Ecommerce", "Yellow Vans", "Economy"),
        ("Bicycle Courier", "Pedal Post", "Express"),
    ],
    "order_source_mapping": [
        ("TikTok", "Short Videos", "Feed"),
        ("web", "Own Shop", "Own"),
        ("kiosk", "Station Kiosk", "Counter"),
    ],
    # two of the codes that the query gives to orders, one only on a platform; and one that none has
    "discount_code_mapping": [
        ("Platform & Seller", "Shared Cost", "Marketplace", True),
        ("BUILD25", "Builders", "Newsletter", False),
        ("RAINY5", "Weather", "Till", False),
    ],
    "product_categories": [
        ("Widget", "Hardware", "Widgets"),
        ("ring", "Jewelry", "Rings"),
        ("RED", "Colour", "Red"),
        ("b_lt", "Hardware", "Fasteners"),
        ("large ring", "Jewelry", "Large"),
        ("nothing like it", "Other", "None"),
    ],
}

SCHEMAS = {
    "shipping_carriers": S.SHIPPING_CARRIERS,
    "order_source_mapping": S.ORDER_SOURCE_MAPPING,
    "discount_code_mapping": S.DISCOUNT_CODE_MAPPING,
    "product_categories": S.PRODUCT_CATEGORIES,
}


def lookup(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(ROWS[name], SCHEMAS[name])


def as_values(name: str) -> str:
    """The table as a SQL VALUES list with named columns."""
    def literal(v):
        return str(v).upper() if isinstance(v, bool) else f"'{v}'"

    rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in ROWS[name])
    return f"(VALUES {rows}) AS {name}({', '.join(SCHEMAS[name].names)})"
