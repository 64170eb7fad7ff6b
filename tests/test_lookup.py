import pytest

from ledgerloom.operators import lookup as lk
from ledgerloom.plans import variants


def test_not_in_follows_sql(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "e string")
    lists = {"some": [("a",), ("a",)], "with_null": [("a",), (None,)], "empty": []}
    for listed in lists.values():
        out = spark.createDataFrame(listed, "x string")
        rows.createOrReplaceTempView("rows_v")
        out.createOrReplaceTempView("listed_v")
        want = spark.sql("SELECT e FROM rows_v WHERE e NOT IN (SELECT x FROM listed_v)").collect()
        got = lk.not_in(rows, "e", out, "x").collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_not_in_stays_an_equality_join(spark):
    plan = _plan(lk.not_in(spark.range(9).selectExpr("string(id) e"), "e", spark.range(3).selectExpr("string(id) x"), "x"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


TITLES = ["red Ring", "RING red ring", "small bolt", "", None, "x", "100% b_lt", "ring"]
WORDS = [("ring", "1", "a"), ("RED", "2", "b"), ("b_lt", "3", "c"), ("0%", "4", "d"), ("", "5", "e"),
         ("not there", "6", "f"), ("ring", "7", "g"), (None, "8", "h")]


def test_keywords_match_like_like(spark):
    df = spark.createDataFrame(list(enumerate(TITLES)), "product_id int, product_title string")
    words = spark.createDataFrame(WORDS, "product_keyword string, category string, subcategory string")
    df.createOrReplaceTempView("p_v")
    words.createOrReplaceTempView("w_v")
    want = spark.sql("""
        SELECT product_id, product_title, coalesce(category, 'Uncategorized') category,
               coalesce(subcategory, 'Other') subcategory
        FROM p_v LEFT JOIN w_v ON lower(product_title) LIKE concat('%', lower(product_keyword), '%')""")
    got = variants.products_with_categories(df, words)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_literal_keywords_need_no_nested_loop(spark):
    df = spark.createDataFrame([(1, "red ring")], "i int, t string")
    words = spark.createDataFrame([("ring",), ("red",)], "k string")
    assert "NestedLoop" not in _plan(lk.contains_keyword(df, "t", words, "k"))


def test_no_keywords_at_all(spark):
    df = spark.createDataFrame([(1, "red ring")], "i int, t string")
    assert lk.contains_keyword(df, "t", spark.createDataFrame([], "k string"), "k").collect() == [(1, "red ring", None)]


def test_only_small_lookups_are_broadcast(spark):
    big = spark.range(50).selectExpr("string(id) k", "id v")
    assert lk.broadcast_if_small(big, rows=49) is big
    assert "hint" in lk.broadcast_if_small(big, rows=50)._jdf.queryExecution().logical().toString().lower()


def test_carriers_and_channels(spark):
    from ledgerloom.catalog.lookups import lookup

    ships = spark.createDataFrame([("1", "fedex ground"), ("2", "OnTrac"), ("3", None)], "fulfillment_id string, shipping_carrier string")
    got = sorted(map(tuple, variants.carriers_by_lookup(ships, lookup(spark, "shipping_carriers")).collect()))
    assert got == [("1", "fedex ground", "Federal Parcel", "Economy"), ("2", "OnTrac", "OnTrac", "Unknown"), ("3", None, None, "Unknown")]
    orders = spark.createDataFrame([("1", "web"), ("2", "pos"), ("3", None)], "order_id string, order_source string")
    got = sorted(map(tuple, variants.orders_by_channel(orders, lookup(spark, "order_source_mapping")).collect()))
    assert got == [("1", "Own Shop", "Own"), ("2", "pos", "Other"), ("3", None, "Other")]


@pytest.mark.parametrize("code, want", [("BUILD25", ("Builders", "Newsletter", False)),
                                        ("Platform & Seller", ("Shared Cost", "Marketplace", True)),
                                        ("nope", ("Unknown", "Unknown", False)), (None, ("Unknown", "Unknown", False))])
def test_discount_details(spark, code, want):
    from ledgerloom.catalog.lookups import lookup

    orders = spark.createDataFrame([("1", code)], "order_id string, discount_code string")
    row = variants.orders_with_discount_details(orders, lookup(spark, "discount_code_mapping")).collect()[0]
    assert (row.discount_category, row.discount_channel, row.is_platform_discount) == want and row.discount_code == code


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_very_many_wildcard_keywords_make_no_nested_loop(spark):
    from ledgerloom.operators.lookup import contains_keyword

    words = [f"pre{i:04d}%suf_x" for i in range(1500)] + ["%", "_", r"100\%", "", "Plain", r"a\_b%c"]
    lookup = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, id int")
    texts = ["pre0007 and sufyx", "PRE1499sufzx!", "100% sure", "100 percent", "plain", "a_b then c", "axb then c", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "title string")
    joined = contains_keyword(df, "title", lookup, "word")
    got = {(r.title, r.word) for r in joined.collect()}

    def like(text, pattern):
        import re

        parts = re.split(r"(\\.|[%_])", pattern.lower())
        rule = "".join(".*" if p == "%" else "." if p == "_" else re.escape(p[1:] if p.startswith("\\") else p) for p in parts)
        return re.search(rule, text.lower(), re.S) is not None

    want = {(t, w) for t in texts if t is not None for w in words if like(t, w)} | {(None, None)}
    assert got == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_broadcast_is_bounded_by_rows_and_bytes(spark):
    def hinted(df, **limits):
        return "strategy=broadcast" in lk.broadcast_if_small(df, **limits)._jdf.queryExecution().analyzed().toString()

    df = spark.createDataFrame([("a" * 90, 1, ["b" * 90]), (None, 2, None)], "`a.b` string, n int, l array<string>")
    assert hinted(df) and hinted(df, rows=2, size=300)
    assert not hinted(df, rows=1) and not hinted(df, size=200) and not hinted(df.select("`a.b`"), size=80)
    assert hinted(df.limit(0), rows=0, size=0)
