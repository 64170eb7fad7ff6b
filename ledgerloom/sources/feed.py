"""The nested order feed derived from the flat star-schema tables (FIXTURES.md, F2).

Repeated (order, line number) pairs become sync versions of that order, which gives a
feed with re-deliveries, changing statuses and lines that vanish from later syncs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.operators.stored import store
from ledgerloom.operators.windows import hot_groups, row_number, with_group_metrics

# Fixed value: the reporting date, the last order date in the tables.
AS_OF = "2001-08-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tables_stamp(spark: SparkSession, folder: str, names: tuple[str, ...]) -> tuple:
    """Number, size, time and fingerprint of the files behind the tables; changes when they do."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = files.load([f"{folder}/{n}.parquet" for n in names])
    mark = F.xxhash64("path", "length", "modificationTime")
    return tuple(found.agg(
        F.count("*"), F.sum("length"), F.max("modificationTime"), F.bit_xor(mark)
    ).collect()[0])


def _cents(amount: Column) -> Column:
    return F.round(amount * 100, 0) / 100


def _flag(test: Column) -> Column:
    return F.when(test, "true").otherwise("false")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _days_after(timestamp: str, days: str) -> Column:
    return F.timestamp_add("DAY", F.col(days).cast("int"), F.col(timestamp))


#: What puts the repeats of an (order, line number) in their order.
VERSION_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
PART_COLUMNS = ("p_name", "p_type", "p_brand", "p_size", "p_retailprice")


def _versioned_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Lines with their version ``v``, the last one of their order ``max_v``, and ``parts``, the rows of their part.

    Parts are joined while a line is narrow, so that one shuffle by order serves the versions and all that is grouped
    by order after them. Where an order has too many lines for one task, every step deals out its own keys instead.
    """
    lines = lineitem.where(F.col("l_orderkey").isNotNull())
    # an array per key, so that a line keeps its number whatever parts there are; stored, as a hot part is split beside a plain scan
    parts = store(
        part.where(F.col("p_partkey").isNotNull()).groupBy("p_partkey").agg(F.collect_list(F.struct(*PART_COLUMNS)).alias("parts")), "parts")
    rows = lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "left").drop("p_partkey")
    keys, order = ["l_orderkey", "l_linenumber"], [F.col(c) for c in VERSION_ORDER]
    whole = hot_groups(lines, {"l_orderkey": F.col("l_orderkey")}) is None
    hot = None if whole else hot_groups(lines, {k: F.col(k) for k in keys})
    numbered = with_group_metrics(rows.repartition("l_orderkey") if whole else rows, keys, order, [row_number("_nth")], hot)
    numbered = numbered.select("*", (F.col("_nth") - 1).alias("v")).drop("_nth", "l_extendedprice", "l_tax", "l_shipdate")
    if whole:
        return numbered.select("*", F.max("v").over(Window.partitionBy("l_orderkey")).alias("max_v"))
    numbered = store(numbered, "versioned_lines")  # read twice
    return numbered.join(numbered.groupBy("l_orderkey").agg(F.max("v").alias("max_v")), "l_orderkey")


def _structs(fields: tuple[str, ...], values: dict[str, Column]) -> Column:
    absent = F.lit(None).cast("string")
    return F.struct(*[values.get(f, absent).alias(f) for f in fields])


def _array(elements: Column) -> Column:
    """The collected (place, element) pairs as an array of elements in their places."""
    return F.transform(F.sort_array(elements), lambda x: x["_e"])


def derive_raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The raw order feed in the :data:`RAW_ORDERS` schema."""
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    part = table(spark, folder, "part")
    # a supplier's lines of a version are one shipment, put beside the first of them
    sent = Window.partitionBy("l_orderkey", "v", "l_suppkey", "l_linestatus")
    placed = sent.orderBy(F.col("l_linenumber").asc_nulls_last())
    lines = _versioned_lines(table(spark, folder, "lineitem"), part).withColumns({
        "rf": F.min("l_returnflag").over(placed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "_nth_sent": F.row_number().over(placed),
    })
    dates = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")

    def line(part: Column) -> Column:
        return _structs(S.LINE_ITEM_FIELDS, {
            "id": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
            "product_id": F.when(F.col("l_partkey") % 97 == 0, F.lit(None))
            .when(
                (F.col("o_orderdate") >= F.lit("2001-07-12").cast("timestamp")) & (F.col("l_linenumber") == 1),
                F.concat(F.lit("N"), _text("l_partkey")),
            )
            .otherwise(_text("l_partkey")),
            "title": part["p_name"],
            "name": F.concat(part["p_name"], F.lit(" - "), part["p_type"]),
            "sku": F.concat(part["p_brand"], F.lit("-"), part["p_size"].cast("string")),
            "vendor": part["p_brand"],
            "variant_title": F.when(part["p_size"] % 3 != 0, part["p_type"]),
            "quantity": F.col("l_quantity").cast("long").cast("string"),
            "price": part["p_retailprice"].cast("string"),
            "total_discount": _text("l_discount"),
            "variant_id": (F.col("l_partkey") * 100 + part["p_size"]).cast("string"),
            "grams": F.when(part["p_size"] % 5 != 0, (part["p_size"] * 10).cast("string")),
            "fulfillment_service": F.when(F.col("l_linenumber") % 2 == 1, "manual").otherwise("carrier"),
            "fulfillment_status": F.when(F.col("l_linestatus") == "F", "fulfilled"),
            "fulfillable_quantity": F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("long").cast("string")).otherwise("0"),
            "requires_shipping": _flag(part["p_size"] % 4 != 0),
            "taxable": _flag(F.col("l_partkey") % 2 == 0),
            "gift_card": _flag(F.col("l_partkey") % 50 == 0),
            "product_exists": _flag(F.col("l_partkey") % 97 != 0),
            "variant_inventory_management": F.when(part["p_size"] % 2 == 0, "own"),
            "admin_graphql_api_id": F.concat(F.lit("gid/line/"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")),
        })

    supplier = F.col("l_suppkey")
    hours_later = F.timestamp_add(
        "HOUR", (5 + F.col("l_linenumber") * 7 + supplier % 48).cast("int"), F.col("o_orderdate")
    )
    companies = {0: "FedEx Ground", 1: "UPS Next Day Air", 2: "usps", 3: "DHL eCommerce", 5: "OnTrac"}
    company = F.lit(None).cast("string")
    for rest, label in companies.items():
        company = F.when(supplier % 6 == rest, label).otherwise(company)
    tracking = F.concat(_text("l_orderkey"), F.lit("-"), supplier.cast("string"))
    shipment = _structs(S.FULFILLMENT_FIELDS, {
        "id": (F.col("l_orderkey") * 10000 + supplier).cast("string"),
        "created_at": F.timestamp_add("MINUTE", (supplier % 60).cast("int"), hours_later).cast("string"),
        "updated_at": F.timestamp_add("DAY", (10 + F.col("v")).cast("int"), F.col("o_orderdate")).cast("string"),
        "tracking_company": company,
        "status": F.lit("SUCCESS"),
        "shipment_status": F.when(F.col("rf") == "A", "DELIVERED")
        .when(F.col("rf") == "N", "In_Transit").otherwise("confirmed"),
        "name": F.concat(F.lit("#JC"), _text("l_orderkey"), F.lit("."), supplier.cast("string")),
        "tracking_number": F.when(supplier % 6 != 4, tracking),
        "tracking_url": F.concat(F.lit("track/"), tracking),
        "tracking_numbers": F.concat(F.lit("["), tracking, F.lit("]")),
        "tracking_urls": F.concat(F.lit("[track/"), tracking, F.lit("]")),
        "service": F.when(supplier % 2 == 0, "manual").otherwise("carrier"),
        "location_id": (supplier % 5).cast("string"),
        "admin_graphql_api_id": F.concat(F.lit("gid/shipment/"), tracking),
    })
    is_first_sent = (F.col("l_linestatus") == "F") & (F.col("_nth_sent") == 1)

    def pair(part: Column) -> Column:
        return F.struct(F.col("l_linenumber").alias("_by"), line(part).alias("_e"))

    # one part is the rule; only an array of several goes through a lambda, which isn't compiled
    pairs = F.when(F.size("parts") == 1, F.array(pair(F.get("parts", F.lit(0))))).otherwise(F.transform("parts", pair))
    elements = lines.join(dates, "l_orderkey").select(
        "l_orderkey", "v", "max_v", pairs.alias("_lines"),
        F.when(is_first_sent, F.struct(supplier.alias("_by"), shipment.alias("_e"))).alias("_sent"))
    # one row per (order, version); a version holds each line number once. Elements are counted as well as collected: what
    # is used once would be made inside the aggregate, field by field and not compiled
    nested = elements.groupBy(F.col("l_orderkey").alias("o_orderkey"), "v").agg(
        F.max("max_v").alias("max_v"),
        F.when(F.count("_lines") > 0, _array(F.flatten(F.collect_list("_lines")))).alias("line_items"),
        F.when(F.count("_sent") > 0, _array(F.collect_list("_sent"))).alias("fulfillments"),
    )

    key = F.col("o_orderkey")
    versioned = orders.join(nested, "o_orderkey", "left").withColumns({
        "v": F.coalesce("v", F.lit(0)), "max_v": F.coalesce("max_v", F.lit(0)),
    })
    no_customer = F.array().cast("array<struct<id:string>>")
    no_lines = F.array().cast(S.RAW_ORDERS["line_items"].dataType)
    values = {
        "id": _text("o_orderkey"),
        "name": F.concat(F.lit("#JC"), _text("o_orderkey")),
        "order_number": _text("o_orderkey"),
        "created_at": _text("o_orderdate"),
        "updated_at": _days_after("o_orderdate", "v").cast("string"),
        "customer": F.when(F.col("o_custkey") % 100 == 99, no_customer)
        .otherwise(F.array(F.struct(_text("o_custkey").alias("id")))),
        "email": F.concat(F.lit("c"), _text("o_custkey"), F.lit("@ex.com")),
        # some orders break the rules that the checks on amounts state
        "total_price": F.when(key % 499 == 7, "-1.5").otherwise(_cents(F.col("o_totalprice") / 1000).cast("string")),
        "subtotal_price": _cents(F.col("o_totalprice") / 1100).cast("string"),
        "total_discounts": F.when(key % 211 == 5, _cents(F.col("o_totalprice") / 900).cast("string"))
        .when(key % 4 == 0, _cents(F.col("o_totalprice") / 9000).cast("string"))
        .otherwise("0.0"),
        "total_tax": _cents(F.col("o_totalprice") / 20000).cast("string"),
        "total_tip_received": F.when(key % 6 == 1, _cents(F.col("o_totalprice") / 15000).cast("string")).otherwise("0.0"),
        "total_line_items_price": _cents(F.col("o_totalprice") / 1050).cast("string"),
        "confirmation_number": F.when(key % 7 != 0, F.concat(F.lit("CN"), _text("o_orderkey"))),
        "processed_at": F.when(key % 11 != 0, F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate")).cast("string")),
        "closed_at": F.when(F.col("o_orderstatus") == "F", F.timestamp_add("DAY", F.lit(20), F.col("o_orderdate")).cast("string")),
        "cancelled_at": F.when(key % 20 == 7, F.timestamp_add("DAY", F.lit(2), F.col("o_orderdate")).cast("string")),
        "currency": F.when(key % 4 == 0, "EUR").otherwise("USD"),
        "presentment_currency": F.when(key % 9 == 0, "GBP").otherwise("USD"),
        "source_identifier": F.when(key % 3 == 0, F.concat(F.lit("S"), _text("o_orderkey"))),
        "phone": F.when(F.col("o_custkey") % 2 == 1, F.concat(F.lit("+1"), _text("o_custkey"))),
        "tags": F.concat(F.lit("tag"), (key % 3).cast("string")),
        "token": F.concat(F.lit("t"), _text("o_orderkey")),
        "app_id": (key % 5).cast("string"),
        "confirmed": F.when(key % 13 != 0, _flag(key % 8 != 0)),
        "taxes_included": _flag(key % 2 == 0),
        "_daton_user_id": F.concat(F.lit("u"), (key % 3).cast("string")),
        "financial_status": F.when(F.col("v") < F.col("max_v"), "PENDING")
        .when(F.col("o_orderstatus") == "F", "Paid")
        .when(F.col("o_orderstatus") == "O", "AUTHORIZED").otherwise("refunded"),
        "fulfillment_status": F.when(F.col("o_orderstatus") == "F", "Fulfilled")
        .when(F.col("o_orderstatus") == "P", "partial"),
        "cancel_reason": F.when(key % 20 == 7, "CUSTOMER"),
        "source_name": F.when(key % 3 == 0, "TikTok").when(key % 3 == 1, "web").otherwise("pos"),
        "referring_site": F.when(key % 5 != 0, F.concat(F.lit("ref"), (key % 5).cast("string"))),
        "test": F.when(key % 50 == 0, "true").when(key % 2 == 0, "false"),
        "buyer_accepts_marketing": F.when(key % 3 == 0, "true").otherwise("false"),
        "_daton_batch_runtime": (F.unix_millis("o_orderdate") + F.col("v") * 86400000).cast("string"),
        "_daton_batch_id": F.concat(F.lit("b"), _text("v")),
        "line_items": F.coalesce("line_items", no_lines),
        "fulfillments": F.col("fulfillments"),
    }
    return versioned.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.RAW_ORDERS
    ])


def land_raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The feed written once, as the raw table that the staging models read."""
    return store(derive_raw_orders(spark, folder), "raw_orders")
