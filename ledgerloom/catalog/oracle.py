"""The same queries as SQL text over the flat tables, for a comparison in another engine.

``RAW_FEED`` is the feed derivation of FIXTURES.md. Each statement is a chain of named
steps; only the steps that a query needs are put in front of it. Doubles are rounded to
six digits, times and dates are text, integers are BIGINT.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from ledgerloom.catalog.feed_models import NULLABLE_FLAGS, NULLABLE_NUMBERS
from ledgerloom.catalog.lookups import as_values
from ledgerloom.schema import FULFILLMENT_FIELDS, LINE_ITEM_FIELDS
from ledgerloom.sources.feed import AS_OF

RAW_FEED = """li AS (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS v
  FROM lineitem l),
ver AS (SELECT o_orderkey, COALESCE(MAX(v), 0) AS max_v
        FROM orders LEFT JOIN li ON l_orderkey = o_orderkey GROUP BY o_orderkey),
ov AS (SELECT o.*, max_v, UNNEST(range(0, max_v + 1)) AS v FROM orders o JOIN ver USING (o_orderkey)),
items AS (
  SELECT l_orderkey, v, list({
     'id': CAST(l_orderkey * 10 + l_linenumber AS VARCHAR),
     'product_id': CASE WHEN l_partkey % 97 = 0 THEN NULL
                        WHEN o_orderdate >= TIMESTAMP '2001-07-12' AND l_linenumber = 1 THEN 'N' || CAST(l_partkey AS VARCHAR)
                        ELSE CAST(l_partkey AS VARCHAR) END,
     'title': p_name, 'name': p_name || ' - ' || p_type,
     'sku': p_brand || '-' || CAST(p_size AS VARCHAR), 'vendor': p_brand,
     'variant_title': CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END,
     'quantity': CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
     'price': CAST(p_retailprice AS VARCHAR),
     'total_discount': CAST(l_discount AS VARCHAR),
     'variant_id': CAST(l_partkey * 100 + p_size AS VARCHAR),
     'grams': CASE WHEN p_size % 5 <> 0 THEN CAST(p_size * 10 AS VARCHAR) END,
     'fulfillment_service': CASE WHEN l_linenumber % 2 = 1 THEN 'manual' ELSE 'carrier' END,
     'fulfillment_status': CASE WHEN l_linestatus = 'F' THEN 'fulfilled' END,
     'fulfillable_quantity': CASE WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE '0' END,
     'requires_shipping': CASE WHEN p_size % 4 <> 0 THEN 'true' ELSE 'false' END,
     'taxable': CASE WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END,
     'gift_card': CASE WHEN l_partkey % 50 = 0 THEN 'true' ELSE 'false' END,
     'product_exists': CASE WHEN l_partkey % 97 <> 0 THEN 'true' ELSE 'false' END,
     'variant_inventory_management': CASE WHEN p_size % 2 = 0 THEN 'own' END,
     'admin_graphql_api_id': 'gid/line/' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)
     } ORDER BY l_linenumber) AS line_items
  FROM li JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
  GROUP BY l_orderkey, v),
ship AS (
  SELECT l_orderkey, v, l_suppkey, MIN(l_returnflag) AS rf, MIN(l_linenumber) AS ln
  FROM li WHERE l_linestatus = 'F' GROUP BY l_orderkey, v, l_suppkey),
ful AS (
  SELECT l_orderkey, v, list({
     'id': CAST(l_orderkey * 10000 + l_suppkey AS VARCHAR),
     'created_at': o_orderdate + to_hours(CAST(5 + ln * 7 + l_suppkey % 48 AS INT)) + to_minutes(CAST(l_suppkey % 60 AS INT)),
     'updated_at': o_orderdate + to_days(CAST(10 + v AS INT)),
     'tracking_company': CASE l_suppkey % 6 WHEN 0 THEN 'FedEx Ground' WHEN 1 THEN 'UPS Next Day Air'
        WHEN 2 THEN 'usps' WHEN 3 THEN 'DHL eCommerce' WHEN 4 THEN NULL ELSE 'OnTrac' END,
     'status': 'SUCCESS',
     'shipment_status': CASE rf WHEN 'A' THEN 'DELIVERED' WHEN 'N' THEN 'In_Transit' ELSE 'confirmed' END,
     'name': '#JC' || l_orderkey || '.' || l_suppkey,
     'tracking_number': CASE WHEN l_suppkey % 6 <> 4 THEN l_orderkey || '-' || l_suppkey END,
     'tracking_url': 'track/' || l_orderkey || '-' || l_suppkey,
     'tracking_numbers': '[' || l_orderkey || '-' || l_suppkey || ']',
     'tracking_urls': '[track/' || l_orderkey || '-' || l_suppkey || ']',
     'service': CASE WHEN l_suppkey % 2 = 0 THEN 'manual' ELSE 'carrier' END,
     'location_id': CAST(l_suppkey % 5 AS VARCHAR),
     'admin_graphql_api_id': 'gid/shipment/' || l_orderkey || '-' || l_suppkey
     } ORDER BY l_suppkey) AS fulfillments
  FROM ship JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, v),
raw_orders AS (
  SELECT CAST(ov.o_orderkey AS VARCHAR) AS id, '#JC' || CAST(ov.o_orderkey AS VARCHAR) AS name,
    CAST(ov.o_orderkey AS VARCHAR) AS order_number,
    ov.o_orderdate AS created_at, ov.o_orderdate + to_days(CAST(ov.v AS INT)) AS updated_at,
    CASE WHEN ov.o_custkey % 100 = 99 THEN [] ELSE [{'id': CAST(ov.o_custkey AS VARCHAR)}] END AS customer,
    'c' || CAST(ov.o_custkey AS VARCHAR) || '@ex.com' AS email,
    CASE WHEN ov.o_orderkey % 499 = 7 THEN '-1.5' ELSE CAST(ROUND(ov.o_totalprice / 1000, 2) AS VARCHAR) END AS total_price,
    CAST(ROUND(ov.o_totalprice / 1100, 2) AS VARCHAR) AS subtotal_price,
    CASE WHEN ov.o_orderkey % 211 = 5 THEN CAST(ROUND(ov.o_totalprice / 900, 2) AS VARCHAR)
         WHEN ov.o_orderkey % 4 = 0 THEN CAST(ROUND(ov.o_totalprice / 9000, 2) AS VARCHAR) ELSE '0.0' END AS total_discounts,
    CAST(ROUND(ov.o_totalprice / 20000, 2) AS VARCHAR) AS total_tax,
    CASE WHEN ov.o_orderkey % 6 = 1 THEN CAST(ROUND(ov.o_totalprice / 15000, 2) AS VARCHAR) ELSE '0.0' END AS total_tip_received,
    CAST(ROUND(ov.o_totalprice / 1050, 2) AS VARCHAR) AS total_line_items_price,
    CASE WHEN ov.o_orderkey % 7 <> 0 THEN 'CN' || ov.o_orderkey END AS confirmation_number,
    CASE WHEN ov.o_orderkey % 11 <> 0 THEN ov.o_orderdate + INTERVAL 1 HOUR END AS processed_at,
    CASE WHEN ov.o_orderstatus = 'F' THEN ov.o_orderdate + INTERVAL 20 DAY END AS closed_at,
    CASE WHEN ov.o_orderkey % 20 = 7 THEN ov.o_orderdate + INTERVAL 2 DAY END AS cancelled_at,
    CASE WHEN ov.o_orderkey % 4 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN ov.o_orderkey % 9 = 0 THEN 'GBP' ELSE 'USD' END AS presentment_currency,
    CASE WHEN ov.o_orderkey % 3 = 0 THEN 'S' || ov.o_orderkey END AS source_identifier,
    CASE WHEN ov.o_custkey % 2 = 1 THEN '+1' || ov.o_custkey END AS phone,
    'tag' || (ov.o_orderkey % 3) AS tags, 't' || ov.o_orderkey AS token, CAST(ov.o_orderkey % 5 AS VARCHAR) AS app_id,
    CASE WHEN ov.o_orderkey % 13 = 0 THEN NULL WHEN ov.o_orderkey % 8 <> 0 THEN 'true' ELSE 'false' END AS confirmed,
    CASE WHEN ov.o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS taxes_included, 'u' || (ov.o_orderkey % 3) AS _daton_user_id,
    CASE WHEN ov.v < ov.max_v THEN 'PENDING' WHEN ov.o_orderstatus = 'F' THEN 'Paid'
         WHEN ov.o_orderstatus = 'O' THEN 'AUTHORIZED' ELSE 'refunded' END AS financial_status,
    CASE ov.o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'P' THEN 'partial' ELSE NULL END AS fulfillment_status,
    CASE WHEN ov.o_orderkey % 20 = 7 THEN 'CUSTOMER' ELSE NULL END AS cancel_reason,
    CASE ov.o_orderkey % 3 WHEN 0 THEN 'TikTok' WHEN 1 THEN 'web' ELSE 'pos' END AS source_name,
    CASE WHEN ov.o_orderkey % 5 = 0 THEN NULL ELSE 'ref' || CAST(ov.o_orderkey % 5 AS VARCHAR) END AS referring_site,
    CASE WHEN ov.o_orderkey % 50 = 0 THEN 'true' WHEN ov.o_orderkey % 2 = 0 THEN 'false' ELSE NULL END AS test,
    CASE WHEN ov.o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END AS buyer_accepts_marketing,
    CAST(epoch_ms(ov.o_orderdate) + ov.v * 86400000 AS VARCHAR) AS _daton_batch_runtime,
    'b' || CAST(ov.v AS VARCHAR) AS _daton_batch_id,
    COALESCE(i.line_items, []) AS line_items, f.fulfillments
  FROM ov LEFT JOIN items i ON i.l_orderkey = ov.o_orderkey AND i.v = ov.v
          LEFT JOIN ful f ON f.l_orderkey = ov.o_orderkey AND f.v = ov.v)"""

# name -> SELECT text; every step may read the ones above it
STEPS: dict[str, str] = {}

STEPS["typed"] = """
SELECT id AS order_id, customer[1].id AS customer_id, name AS order_name,
  order_number::BIGINT AS order_number, created_at AS order_created_at,
  updated_at AS order_updated_at, subtotal_price::DOUBLE AS subtotal_amount,
  total_discounts::DOUBLE AS discount_amount, total_tax::DOUBLE AS tax_amount,
  total_price::DOUBLE AS total_amount, total_tip_received::DOUBLE AS tip_amount,
  lower(financial_status) AS payment_status,
  lower(ifnull(fulfillment_status, 'UNFULFILLED')) AS fulfillment_status,
  lower(cancel_reason) AS cancellation_reason, source_name AS order_source,
  ifnull(referring_site, 'direct') AS referring_site, email AS customer_email,
  test::BOOLEAN AS is_test_order, buyer_accepts_marketing::BOOLEAN AS accepts_marketing,
  confirmation_number, processed_at AS order_processed_at, closed_at AS order_closed_at, cancelled_at AS order_cancelled_at,
  total_line_items_price::DOUBLE AS line_items_total, currency AS order_currency, presentment_currency, source_identifier,
  phone AS customer_phone, confirmed::BOOLEAN AS is_confirmed, taxes_included::BOOLEAN AS is_tax_inclusive,
  tags AS order_tags, app_id, token AS order_token, _daton_user_id,
  epoch_ms(_daton_batch_runtime::BIGINT) AS synced_at, _daton_batch_id
FROM raw_orders"""

STEPS["newest"] = """
SELECT * FROM typed QUALIFY row_number() OVER
  (PARTITION BY order_id ORDER BY synced_at DESC, order_updated_at DESC, _daton_batch_id DESC) = 1"""

STEPS["so"] = """
SELECT *, lag(order_created_at) OVER c AS previous_order_at,
  datediff('day', lag(order_created_at) OVER c, order_created_at)::BIGINT AS days_since_previous_order,
  (row_number() OVER c)::BIGINT AS customer_order_sequence,
  sum(total_amount) OVER (c ROWS UNBOUNDED PRECEDING) AS customer_running_total,
  count(*) OVER (PARTITION BY customer_id) AS customer_total_orders,
  sum(total_amount) OVER (PARTITION BY customer_id) AS customer_lifetime_value,
  row_number() OVER c = 1 AS is_first_order,
  (row_number() OVER (PARTITION BY order_created_at::DATE ORDER BY order_created_at, order_id))::BIGINT
    AS daily_order_sequence
FROM newest WHERE is_test_order IS DISTINCT FROM true
WINDOW c AS (PARTITION BY customer_id ORDER BY order_created_at, order_id)"""

STEPS["every_line"] = """
SELECT id AS order_id, order_number, created_at AS order_created_at,
  epoch_ms(_daton_batch_runtime::BIGINT) AS synced_at, _daton_batch_id, unnest(line_items) AS x
FROM raw_orders"""

STEPS["typed_lines"] = """
SELECT order_id, x.id AS line_item_id, synced_at, _daton_batch_id, order_number, order_created_at,
  x.product_id AS product_id, x.sku AS product_sku, x.title AS product_title,
  x.name AS product_name, x.variant_title AS variant_title, x.vendor AS product_vendor,
  x.quantity::BIGINT AS quantity, x.price::DOUBLE AS unit_price,
  x.total_discount::DOUBLE AS line_discount_amount,
  x.quantity::BIGINT * x.price::DOUBLE AS line_total_before_discount, x.variant_id AS variant_id,
  x.grams::BIGINT AS weight_grams, x.fulfillment_service AS fulfillment_service, x.fulfillment_status AS fulfillment_status,
  x.fulfillable_quantity::BIGINT AS fulfillable_quantity, x.requires_shipping::BOOLEAN AS requires_shipping,
  x.taxable::BOOLEAN AS is_taxable, x.gift_card::BOOLEAN AS is_gift_card, x.product_exists::BOOLEAN AS product_exists,
  x.variant_inventory_management AS inventory_management, x.admin_graphql_api_id AS admin_graphql_api_id
FROM every_line"""

STEPS["newest_lines"] = """
SELECT * FROM typed_lines QUALIFY row_number() OVER
  (PARTITION BY order_id, line_item_id ORDER BY synced_at DESC, order_created_at DESC) = 1"""

STEPS["sl"] = """
SELECT *, (row_number() OVER (PARTITION BY order_id ORDER BY line_item_id))::BIGINT AS line_item_sequence,
  count(*) OVER o AS order_line_item_count, (sum(quantity) OVER o)::BIGINT AS order_total_quantity,
  line_total_before_discount / nullif(sum(line_total_before_discount) OVER o, 0) AS line_share_of_order,
  count(*) OVER o = 1 AS is_single_item_order
FROM newest_lines WINDOW o AS (PARTITION BY order_id)"""

STEPS["every_shipment"] = """
SELECT id AS order_id, name AS order_name, order_number, created_at AS order_created_at,
  epoch_ms(_daton_batch_runtime::BIGINT) AS synced_at, _daton_batch_id, unnest(fulfillments) AS x
FROM raw_orders"""

STEPS["typed_shipments"] = """
SELECT x.id AS fulfillment_id, synced_at, _daton_batch_id, order_id, order_number, order_name,
  order_created_at, x.created_at AS fulfilled_at, x.updated_at AS fulfillment_updated_at,
  x.tracking_company AS shipping_carrier, lower(x.status) AS fulfillment_status,
  lower(x.shipment_status) AS shipment_status, x.name AS fulfillment_name, x.tracking_number AS tracking_number,
  x.tracking_url AS tracking_url, x.tracking_numbers AS tracking_numbers_raw, x.tracking_urls AS tracking_urls_raw,
  x.service AS fulfillment_service, x.location_id AS fulfillment_location_id, x.admin_graphql_api_id AS admin_graphql_api_id
FROM every_shipment"""

STEPS["newest_shipments"] = """
SELECT * FROM typed_shipments QUALIFY row_number() OVER
  (PARTITION BY fulfillment_id ORDER BY fulfillment_updated_at DESC, synced_at DESC) = 1"""

STEPS["ss"] = """
SELECT *, datesub('hour', order_created_at, fulfilled_at) AS hours_to_fulfill,
  datesub('day', order_created_at, fulfilled_at) AS days_to_fulfill,
  (row_number() OVER (PARTITION BY order_id ORDER BY fulfilled_at, fulfillment_id))::BIGINT AS fulfillment_sequence,
  count(*) OVER o AS order_fulfillment_count, count(*) OVER o > 1 AS is_split_shipment,
  CASE WHEN shipping_carrier IS NULL THEN 'Unknown'
       WHEN contains(lower(shipping_carrier), 'fedex') THEN 'FedEx'
       WHEN contains(lower(shipping_carrier), 'ups') THEN 'UPS'
       WHEN contains(lower(shipping_carrier), 'usps') THEN 'USPS'
       WHEN contains(lower(shipping_carrier), 'dhl') THEN 'DHL'
       ELSE shipping_carrier END AS shipping_carrier_standardized,
  ifnull(shipment_status = 'delivered', false) AS is_delivered,
  ifnull(shipment_status = 'in_transit', false) AS is_in_transit
FROM newest_shipments WINDOW o AS (PARTITION BY order_id)"""

STEPS["line_sums"] = """
SELECT order_id, count(*) AS line_item_count, sum(quantity)::BIGINT AS total_quantity,
  sum(line_total_before_discount) AS line_items_total
FROM sl GROUP BY order_id"""

STEPS["shipment_sums"] = """
SELECT order_id, min(fulfilled_at) AS first_fulfilled_at, max(fulfilled_at) AS last_fulfilled_at,
  count(*) AS fulfillment_count, bool_or(is_delivered) AS is_fully_delivered
FROM ss GROUP BY order_id"""

STEPS["enriched"] = """
SELECT so.* EXCLUDE (order_updated_at, line_items_total),
  ifnull(line_item_count, 0) AS line_item_count, ifnull(l.total_quantity, 0) AS total_quantity,
  ifnull(l.line_items_total, 0) AS line_items_total, first_fulfilled_at, last_fulfilled_at,
  ifnull(fulfillment_count, 0) AS fulfillment_count, ifnull(s.is_fully_delivered, false) AS is_fully_delivered,
  datesub('hour', order_created_at, first_fulfilled_at) AS hours_to_first_fulfillment,
  cancellation_reason IS NOT NULL AS is_canceled,
  CASE WHEN total_amount >= 250 OR total_amount IS NULL THEN 'enterprise'
       WHEN total_amount >= 100 THEN 'large' WHEN total_amount >= 25 THEN 'medium'
       ELSE 'small' END AS order_size_bucket,
  discount_amount / nullif(subtotal_amount, 0) AS discount_rate
FROM so LEFT JOIN line_sums l USING (order_id) LEFT JOIN shipment_sums s USING (order_id)"""

STEPS["per_customer"] = f"""
SELECT customer_id, count(*) AS total_orders, sum(total_amount) AS lifetime_revenue,
  avg(total_amount) AS average_order_value, min(total_amount) AS min_order_value,
  max(total_amount) AS max_order_value, min(order_created_at) AS first_order_at,
  max(order_created_at) AS most_recent_order_at,
  count(*) FILTER (accepts_marketing) AS orders_with_marketing_consent,
  count(*) FILTER (discount_amount > 0) AS orders_with_discount,
  sum(discount_amount) AS total_discounts_used,
  (array_agg(order_source ORDER BY order_created_at, order_id))[1] AS acquisition_source,
  (array_agg(customer_email ORDER BY order_created_at DESC, order_id DESC))[1] AS customer_email,
  count(*) FILTER (is_first_order) AS first_orders,
  list_sort(list(DISTINCT order_source) FILTER (order_source IS NOT NULL)) AS order_sources,
  count(*) FILTER (payment_status = 'refunded') AS refunded_orders,
  count(cancellation_reason) AS canceled_orders,
  datediff('day', min(order_created_at), DATE '{AS_OF}')::BIGINT AS days_as_customer,
  datediff('day', max(order_created_at), DATE '{AS_OF}')::BIGINT AS days_since_last_order,
  datediff('day', min(order_created_at), max(order_created_at)) AS span_days
FROM so WHERE customer_id IS NOT NULL GROUP BY customer_id"""

STEPS["history"] = """
SELECT *, span_days / CASE WHEN total_orders > 1 THEN total_orders - 1 ELSE 1 END AS avg_days_between_orders,
  orders_with_discount / total_orders AS discount_usage_rate,
  CASE WHEN total_orders > 10 THEN 'champion' WHEN total_orders > 3 THEN 'loyal'
       WHEN total_orders > 1 THEN 'developing' ELSE 'one_time' END AS frequency_segment,
  CASE WHEN days_since_last_order > 180 THEN 'churned' WHEN days_since_last_order > 90 THEN 'at_risk'
       WHEN days_since_last_order > 30 THEN 'cooling' ELSE 'active' END AS recency_segment,
  CASE WHEN lifetime_revenue >= 2000 THEN 'vip' WHEN lifetime_revenue >= 500 THEN 'high_value'
       WHEN lifetime_revenue >= 100 THEN 'medium_value' ELSE 'low_value' END AS value_segment
FROM per_customer"""

STEPS["fo"] = """
SELECT *, order_created_at::DATE AS order_date, year(order_created_at) AS order_year,
  month(order_created_at) AS order_month, dayofweek(order_created_at) + 1 AS order_day_of_week,
  hour(order_created_at) AS order_hour
FROM enriched"""

STEPS["daily"] = """
SELECT order_date, order_year, order_month, dayofweek(order_date) + 1 AS day_of_week,
  count(*) AS order_count, count(*) FILTER (is_first_order) AS new_customer_orders,
  count(*) FILTER (NOT is_first_order) AS returning_customer_orders,
  count(*) FILTER (is_canceled) AS canceled_order_count,
  sum(total_amount) AS total_revenue, sum(subtotal_amount) AS gross_revenue,
  sum(discount_amount) AS total_discounts, sum(tax_amount) AS total_tax, sum(tip_amount) AS total_tips,
  avg(total_amount) AS average_order_value, avg(line_item_count) AS avg_items_per_order,
  avg(total_quantity) AS avg_units_per_order, avg(hours_to_first_fulfillment) AS avg_hours_to_fulfill,
  count(*) FILTER (is_fully_delivered) AS fully_delivered_count,
  count(*) FILTER (order_source = 'web') AS web_orders,
  count(*) FILTER (order_source = 'TikTok') AS tiktok_orders,
  count(DISTINCT customer_id) AS unique_customers,
  sum(total_amount) / nullif(count(DISTINCT customer_id), 0) AS revenue_per_customer,
  count(*) FILTER (is_first_order) / count(*) AS new_customer_rate,
  sum(discount_amount) / nullif(sum(subtotal_amount), 0) AS discount_rate
FROM fo WHERE NOT is_canceled GROUP BY order_date, order_year, order_month"""

STEPS["dc"] = """
SELECT *, first_order_at::DATE AS first_order_date, most_recent_order_at::DATE AS most_recent_order_date,
  total_orders AS lifetime_order_count, lifetime_revenue AS lifetime_value,
  orders_with_marketing_consent > 0 AS has_marketing_consent,
  recency_segment || '_' || frequency_segment || '_' || value_segment AS rfm_segment,
  CASE value_segment WHEN 'vip' THEN 'platinum' WHEN 'medium_value' THEN 'silver'
    WHEN 'high_value' THEN CASE WHEN total_orders > 3 THEN 'gold' ELSE 'silver' END
    ELSE 'bronze' END AS customer_tier,
  recency_segment = 'churned' OR (recency_segment = 'at_risk' AND lifetime_revenue >= 500) AS is_at_churn_risk
FROM history"""

STEPS["per_product"] = """
SELECT product_id,
  (array_agg({'t': product_title, 'n': product_name, 's': product_sku, 'v': product_vendor, 'r': variant_title}
     ORDER BY order_created_at DESC, order_id DESC, line_item_id DESC))[1] AS a,
  count(DISTINCT order_id) AS order_count, sum(quantity)::BIGINT AS total_quantity_sold,
  avg(quantity) AS avg_quantity_per_order, sum(line_total_before_discount) AS total_revenue,
  sum(line_discount_amount) AS total_discounts, avg(unit_price) AS average_selling_price,
  min(order_created_at)::DATE AS first_sold_date, max(order_created_at)::DATE AS last_sold_date
FROM sl WHERE product_id IS NOT NULL GROUP BY product_id"""

STEPS["ranked_products"] = f"""
SELECT *, a.t AS product_title, a.n AS product_name, a.s AS product_sku, a.v AS vendor,
  a.r AS variant_title, total_revenue / nullif(total_quantity_sold, 0) AS revenue_per_unit,
  datediff('day', last_sold_date, DATE '{AS_OF}')::BIGINT AS days_since_last_sale,
  datediff('day', first_sold_date, DATE '{AS_OF}') AS days_on_sale,
  rank() OVER (ORDER BY round(total_revenue, 6) DESC) AS revenue_rank,
  rank() OVER (ORDER BY total_quantity_sold DESC) AS quantity_rank
FROM per_product"""

STEPS["dp"] = """
SELECT *, CASE WHEN revenue_rank > 100 THEN 'other' WHEN revenue_rank > 50 THEN 'top_100'
    WHEN revenue_rank > 10 THEN 'top_50' ELSE 'top_10' END AS product_tier,
  CASE WHEN days_since_last_sale > 90 THEN 'dormant' WHEN days_on_sale > 30 THEN 'active'
    ELSE 'new' END AS product_status
FROM ranked_products"""

STEPS["order_changes"] = """
SELECT *, lead(synced_at) OVER o AS valid_to, lead(synced_at) OVER o IS NULL AS is_current,
  synced_at AS valid_from
FROM (SELECT *, row_number() OVER o = 1
        OR (payment_status, fulfillment_status, cancellation_reason, total_amount) IS DISTINCT FROM
           lag((payment_status, fulfillment_status, cancellation_reason, total_amount)) OVER o AS changed
      FROM typed WINDOW o AS (PARTITION BY order_id ORDER BY synced_at, order_updated_at, _daton_batch_id))
WHERE changed WINDOW o AS (PARTITION BY order_id ORDER BY synced_at, order_updated_at, _daton_batch_id)"""

STEPS["days"] = """
SELECT unnest(generate_series(min(order_created_at)::DATE, max(order_created_at)::DATE,
  INTERVAL 1 DAY))::DATE AS date_day FROM so"""

STEPS["calendar"] = """
SELECT unnest(generate_series(least(DATE '2020-01-01', min(order_created_at)::DATE),
  greatest(DATE '2030-12-31', max(order_created_at)::DATE), INTERVAL 1 DAY))::DATE AS date_day FROM so"""

# the models' names in the declared checks
MODEL_STEPS = {
    "raw_orders": "raw_orders", "stg_orders": "so", "stg_line_items": "sl", "stg_fulfillments": "ss",
    "int_orders_enriched": "enriched", "int_customer_history": "history", "fct_orders": "fo",
    "fct_daily_revenue": "daily", "dim_customers": "dc", "dim_products": "dp",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def _chain(final: str) -> str:
    """The final SELECT with the steps it reads, directly or not, in front."""
    needed, names = set(), {w for w in _WORD.findall(final)}
    for name in reversed(STEPS):
        if name in names:
            needed.add(name)
            names |= set(_WORD.findall(STEPS[name]))
    parts = [RAW_FEED] if "raw_orders" in names else []
    parts += [f"{n} AS ({STEPS[n].strip()})" for n in STEPS if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def _select(columns: str, source: str) -> str:
    """SELECT list from ``name[:kind][=expression]`` words.

    f rounds a double, i casts to BIGINT, d and t print dates and times.
    """
    out = []
    for word in columns.split():
        head, _, expression = word.partition("=")
        name, _, kind = head.partition(":")
        value = expression or name
        value = {
            "f": f"CAST(round(CAST({value} AS DECIMAL(38, 9)), 6) AS DOUBLE)",
            "i": f"CAST({value} AS BIGINT)",
            "d": f"CAST({value} AS VARCHAR)",
            "t": f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')",
            "s": f"CAST({value} AS VARCHAR)",
            "": value,
        }[kind]
        if name in NULLABLE_NUMBERS:
            value = f"CAST({value} AS DOUBLE)"
        elif name in NULLABLE_FLAGS:
            value = f"CAST({value} AS VARCHAR)"
        out.append(f"{value} AS {name}")
    return "SELECT " + ", ".join(out) + " FROM " + source


ORDER_FACT = (
    "order_id customer_id order_name order_number order_created_at:t subtotal_amount:f "
    "discount_amount:f tax_amount:f total_amount:f tip_amount:f payment_status fulfillment_status "
    "order_source referring_site accepts_marketing is_first_order customer_order_sequence "
    "customer_lifetime_value:f customer_total_orders "
)
ENRICHED = (
    "line_item_count:i total_quantity:i line_items_total:f fulfillment_count:i is_fully_delivered "
    "hours_to_first_fulfillment:i is_canceled order_size_bucket discount_rate:f "
)
CUSTOMER_SUMS = (
    "customer_id total_orders lifetime_revenue:f average_order_value:f min_order_value:f "
    "max_order_value:f first_order_at:t most_recent_order_at:t orders_with_marketing_consent "
    "orders_with_discount total_discounts_used:f days_as_customer days_since_last_order "
    "discount_usage_rate:f frequency_segment recency_segment value_segment "
)
CUSTOMER_DIM = (
    "customer_id customer_email acquisition_source first_order_date:d most_recent_order_date:d "
    "days_since_last_order days_as_customer lifetime_order_count lifetime_value:f "
    "average_order_value:f min_order_value:f max_order_value:f total_discounts_used:f "
    "discount_usage_rate:f has_marketing_consent frequency_segment recency_segment "
    "value_segment rfm_segment customer_tier is_at_churn_risk "
)
DAILY_BOTH = (
    "order_date:d order_year:i order_month:i order_count new_customer_orders "
    "returning_customer_orders total_revenue:f gross_revenue:f total_discounts:f total_tax:f "
    "total_tips:f average_order_value:f avg_items_per_order:f avg_units_per_order:f "
    "avg_hours_to_fulfill:f unique_customers revenue_per_customer:f new_customer_rate:f discount_rate:f "
)
LINE_METRICS = "line_item_sequence order_line_item_count order_total_quantity line_share_of_order:f "
DATE_FLAGS = (
    f"is_today=date_day=DATE'{AS_OF}' is_yesterday=date_day+1=DATE'{AS_OF}' "
    f"is_current_month=date_day>=date_trunc('month',DATE'{AS_OF}') "
    f"is_current_year=date_day>=date_trunc('year',DATE'{AS_OF}') "
)

_SPLIT_ORDERS = (
    "order_id customer_order_sequence previous_order_at:t days_since_previous_order "
    "customer_running_total:f customer_total_orders customer_lifetime_value:f is_first_order "
    "daily_order_sequence"
)

# query -> (columns, source), put together by _select
SELECTS: dict[str, tuple[str, str]] = {
    "scan_lookup_csv": (
        "country_code:s=n_nationkey country_name=n_name region=r_name",
        "nation LEFT JOIN region ON r_regionkey = n_regionkey"),
    "raw_profile": (
        "total_rows=count(*) first_created_at:t=min(created_at) last_created_at:t=max(created_at)", "raw_orders"),
    "project_rename": ("order_id=id order_name=name order_source=source_name customer_email=email", "raw_orders"),
    "cast_types": (
        "order_id _daton_batch_id order_number order_created_at:t order_updated_at:t subtotal_amount:f "
        "tax_amount:f is_test_order accepts_marketing", "typed"),
    "epoch_millis": ("order_id _daton_batch_id synced_at:t", "typed"),
    "customer_from_array": ("order_id _daton_batch_id customer_id", "typed"),
    "null_defaults": (
        "order_id _daton_batch_id payment_status fulfillment_status referring_site cancellation_reason", "typed"),
    "exclude_test_orders": ("order_id is_test_order", "newest WHERE is_test_order IS NULL OR NOT is_test_order"),
    "filter_null_keys": ("order_id line_item_id product_id", "sl WHERE product_id IS NOT NULL"),
    "order_size_bucket": ("order_id total_amount:f order_size_bucket", "enriched"),
    "frequency_segment": (
        "customer_id total_orders days_since_last_order lifetime_revenue:f frequency_segment "
        "recency_segment value_segment", "history"),
    "rfm_segment": ("customer_id rfm_segment", "dc"),
    "customer_tier": ("customer_id customer_tier is_at_churn_risk has_marketing_consent", "dc"),
    "carrier_standardize": ("fulfillment_id shipping_carrier shipping_carrier_standardized", "ss"),
    "line_total": (
        "order_id line_item_id _daton_batch_id quantity unit_price:f line_total_before_discount:f", "typed_lines"),
    "date_relative_flags": ("date_day:d " + DATE_FLAGS, "days"),
    "star_query": (
        "value_segment customer_tier vendor total_revenue:f=sum(line_total_before_discount) order_count=count(*)",
        "fo LEFT JOIN dc USING (customer_id) JOIN sl USING (order_id) LEFT JOIN dp USING (product_id) "
        "WHERE order_date >= DATE '2000-01-01' AND value_segment = 'vip' GROUP BY ALL"),
    "order_lookup": (
        "order_id payment_status fulfillment_status synced_at:t",
        "so WHERE order_id = (SELECT id FROM raw_orders GROUP BY id ORDER BY count(*) DESC, id LIMIT 1)"),
    "explode_line_items": (
        "order_id _daton_batch_id line_item_id product_id product_title quantity", "typed_lines"),
    "explode_outer_line_items": (
        "order_id _daton_batch_id line_item_id product_id product_title quantity",
        "(SELECT order_id, _daton_batch_id, line_item_id, product_id, product_title, quantity FROM typed_lines "
        "UNION ALL SELECT id, _daton_batch_id, NULL, NULL, NULL, NULL FROM raw_orders WHERE len(line_items) = 0)"),
    "explode_fulfillments": (
        "order_id _daton_batch_id fulfillment_id fulfilled_at:t fulfillment_updated_at:t shipping_carrier "
        "fulfillment_status shipment_status", "typed_shipments"),
    "flatten_generic": ("order_id _daton_batch_id customer_id", "typed"),
    "array_length": (
        "order_id=id _daton_batch_id n_lines:i=len(line_items) n_fulfillments:i=len(fulfillments)", "raw_orders"),
    "rejoin_children": (
        "order_id total_amount:f product_title quantity tracking_number shipment_status",
        "so LEFT JOIN sl USING (order_id) LEFT JOIN ss USING (order_id)"),
    "dedup_latest_order": ("order_id payment_status total_amount:f synced_at:t _daton_batch_id", "newest"),
    "dedup_composite_key": (
        "order_id line_item_id synced_at:t product_id quantity unit_price:f", "newest_lines"),
    "dedup_fulfillment": (
        "fulfillment_id order_id fulfillment_updated_at:t shipment_status", "newest_shipments"),
    "dedup_distinct": (
        "order_id payment_status total_amount:f",
        "(SELECT DISTINCT order_id, payment_status, total_amount FROM typed)"),
    "dedup_group_max": (
        "order_id payment_status=max(payment_status) total_amount:f=max(total_amount) "
        "latest_sync:t=max(synced_at)", "typed GROUP BY order_id"),
    "dedup_max_join": (
        "order_id synced_at:t payment_status _daton_batch_id",
        "typed WHERE (order_id, synced_at) IN (SELECT (order_id, max(synced_at)) FROM typed GROUP BY order_id)"),
    "dedup_qualify": ("order_id payment_status synced_at:t", "newest"),
    "dedup_debug_rank": (
        "order_id synced_at:t debug_row_num:i",
        "(SELECT order_id, synced_at, row_number() OVER (PARTITION BY order_id ORDER BY synced_at DESC, "
        "order_updated_at DESC, _daton_batch_id DESC) AS debug_row_num FROM typed)"),
    "duplicate_report": (
        "order_id=id duplicate_count=count(*)",
        "raw_orders GROUP BY id HAVING count(*) > 1 ORDER BY count(*) DESC, id LIMIT 20"),
    "sync_history": (
        "order_id=id times_synced=count(*) first_sync=min(_daton_batch_runtime::BIGINT) "
        "last_sync=max(_daton_batch_runtime::BIGINT)",
        "raw_orders GROUP BY id HAVING count(*) > 1 ORDER BY count(*) DESC, id LIMIT 10"),
    "duplicate_rows": (
        "order_id synced_at:t payment_status",
        "typed WHERE order_id IN (SELECT order_id FROM typed GROUP BY order_id HAVING count(*) > 1)"),
    "customer_order_sequence": ("order_id customer_order_sequence", "so"),
    "previous_order": ("order_id previous_order_at:t days_since_previous_order", "so"),
    "running_total": ("order_id customer_running_total:f", "so"),
    "partition_totals": ("order_id customer_total_orders customer_lifetime_value:f", "so"),
    "is_first_order": ("order_id is_first_order", "so"),
    "daily_sequence": ("order_id daily_order_sequence", "so"),
    "customer_windows_split": (_SPLIT_ORDERS, "so"),
    "line_windows_split": ("order_id line_item_id " + LINE_METRICS, "sl"),
    "line_sequence": ("order_id line_item_id line_item_sequence", "sl"),
    "line_share": ("order_id line_item_id line_share_of_order:f is_single_item_order", "sl"),
    "split_shipment": (
        "fulfillment_id order_id fulfillment_sequence order_fulfillment_count is_split_shipment", "ss"),
    "hours_to_fulfill": ("fulfillment_id hours_to_fulfill days_to_fulfill", "ss"),
    "next_order": (
        "order_id next_order_at:t",
        "(SELECT order_id, lead(order_created_at) OVER (PARTITION BY customer_id "
        "ORDER BY order_created_at, order_id) AS next_order_at FROM so)"),
    "order_quartiles": (
        "order_id total_amount:f quartile:i",
        "(SELECT order_id, total_amount, ntile(4) OVER (ORDER BY total_amount, order_id) AS quartile FROM so)"),
    "order_percent_rank": (
        "order_id total_amount:f percent_rank:f=pr",
        "(SELECT order_id, total_amount, percent_rank() OVER (ORDER BY total_amount) AS pr FROM so)"),
    "moving_avg_7": (
        "order_date:d total_revenue:f revenue_avg_7:f",
        "(SELECT order_date, total_revenue, avg(total_revenue) OVER (ORDER BY order_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_avg_7 FROM daily)"),
    "product_ranks": ("product_id revenue_rank quantity_rank", "ranked_products"),
    "product_tier": ("product_id product_tier product_status days_since_last_sale", "dp"),
    "order_date_parts": (
        "order_id order_date:d order_year:i order_month:i order_day_of_week:i order_hour:i", "fo"),
    "event_time_parts": (
        "event_id event_date:d=ts::DATE event_year:i=year(ts) event_month:i=month(ts) "
        "event_day_of_week:i=dayofweek(ts)+1 event_hour:i=hour(ts)", "events"),
    "safe_divide_rates": (
        "order_id discount_rate:f=discount_amount/nullif(subtotal_amount,0) "
        "tip_per_discount:f=tip_amount/nullif(discount_amount,0)", "so"),
    "avg_days_between_orders": (
        "customer_id avg_days_between_orders:f days_as_customer discount_usage_rate:f", "history"),
    "lookup_join": (
        "customer_id lifetime_revenue:f country_code:s=c_nationkey country_name=n_name region=r_name",
        "history LEFT JOIN customer ON c_custkey = customer_id::BIGINT "
        "LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"),
    "lookup_join_ci": (
        "fulfillment_id original_carrier=shipping_carrier carrier=ifnull(standardized_name,shipping_carrier) "
        "carrier_type=ifnull(carrier_type,'Unknown')",
        f"ss LEFT JOIN {as_values('shipping_carriers')} ON lower(raw_carrier_name) = lower(shipping_carrier)"),
    "map_order_source": (
        "order_id order_source=ifnull(clean_source,order_source) channel_type=ifnull(channel_type,'Other')",
        f"so LEFT JOIN {as_values('order_source_mapping')} ON raw_source = order_source"),
    "map_discount_code": (
        "order_id total_amount:f discount_code=code "
        "discount_category=ifnull(discount_category,'Unknown') discount_channel=ifnull(discount_channel,'Unknown') "
        "is_platform_discount=ifnull(is_platform_discount,false)",
        "(SELECT order_id, total_amount, ['BUILD25', 'WELCOME10', 'Platform & Seller', 'UNLISTED'][order_number % 7 + 1] "
        f"AS code FROM so) LEFT JOIN {as_values('discount_code_mapping')} ON discount_code = code"),
    "keyword_like_join": (
        "product_id product_title category=ifnull(category,'Uncategorized') subcategory=ifnull(subcategory,'Other')",
        f"dp LEFT JOIN {as_values('product_categories')} ON product_title ILIKE '%' || product_keyword || '%'"),
    "exclude_list_anti": (
        "order_id customer_email",
        "so WHERE customer_email NOT IN (SELECT 'c' || c_custkey || '@ex.com' FROM customer "
        "WHERE c_mktsegment = 'MACHINERY')"),
    "fulfillment_summary": (
        "order_id first_fulfilled_at:t last_fulfilled_at:t fulfillment_count is_fully_delivered", "shipment_sums"),
    "line_summary": ("order_id line_item_count total_quantity line_items_total:f", "line_sums"),
    "acquisition_source": ("customer_id acquisition_source customer_email", "history"),
    "product_latest_attrs": (
        "product_id product_title product_name product_sku vendor variant_title", "ranked_products"),
    "customer_sources": ("customer_id order_sources=array_to_string(order_sources,',')", "per_customer"),
    "stg_orders": (
        "order_id customer_id order_name order_number confirmation_number order_created_at:t "
        "order_processed_at:t order_updated_at:t order_closed_at:t order_cancelled_at:t subtotal_amount:f "
        "discount_amount:f tax_amount:f total_amount:f line_items_total:f tip_amount:f order_currency "
        "presentment_currency payment_status fulfillment_status cancellation_reason order_source "
        "source_identifier referring_site customer_email customer_phone is_confirmed is_test_order "
        "is_tax_inclusive accepts_marketing order_tags app_id order_token _daton_user_id "
        "synced_at:t _daton_batch_id " + _SPLIT_ORDERS.removeprefix("order_id "), "so"),
    "stg_line_items": (
        "order_id line_item_id synced_at:t _daton_batch_id order_number order_created_at:t product_id "
        "variant_id product_sku product_title product_name variant_title product_vendor quantity "
        "unit_price:f line_discount_amount:f weight_grams line_total_before_discount:f "
        "fulfillment_service fulfillment_status fulfillable_quantity requires_shipping "
        "is_taxable is_gift_card product_exists inventory_management admin_graphql_api_id "
        + LINE_METRICS + "is_single_item_order", "sl"),
    "stg_fulfillments": (
        "fulfillment_id synced_at:t _daton_batch_id order_id order_number order_name order_created_at:t "
        "fulfillment_name fulfilled_at:t fulfillment_updated_at:t shipping_carrier tracking_number "
        "tracking_url tracking_numbers_raw tracking_urls_raw fulfillment_status shipment_status "
        "fulfillment_service fulfillment_location_id admin_graphql_api_id hours_to_fulfill "
        "days_to_fulfill fulfillment_sequence order_fulfillment_count is_split_shipment "
        "shipping_carrier_standardized is_delivered is_in_transit", "ss"),
    "latest_version_lines": (
        "order_id line_item_id quantity", "typed_lines SEMI JOIN newest USING (order_id, _daton_batch_id)"),
    "orders_enriched": (
        ORDER_FACT + ENRICHED + "order_processed_at:t cancellation_reason first_fulfilled_at:t "
        "last_fulfilled_at:t", "enriched"),
    "customer_history": (
        CUSTOMER_SUMS + "acquisition_source customer_email avg_days_between_orders:f", "history"),
    "fct_orders": (
        ORDER_FACT + ENRICHED + "order_date:d order_year:i order_month:i order_day_of_week:i order_hour:i", "fo"),
    "daily_revenue": (DAILY_BOTH, "daily"),
    "dim_customers": (CUSTOMER_DIM + "avg_days_between_orders:f", "dc"),
    "dim_products": (
        "product_id product_title product_name product_sku vendor variant_title order_count "
        "total_quantity_sold total_revenue:f total_discounts:f avg_quantity_per_order:f "
        "average_selling_price:f revenue_per_unit:f first_sold_date:d last_sold_date:d "
        "days_since_last_sale revenue_rank quantity_rank product_tier product_status", "dp"),
    "dim_dates": (
        "date_day:d date_key=strftime(date_day,'%Y%m%d') year:i=year(date_day) quarter:i=quarter(date_day) "
        "month:i=month(date_day) week_of_year:i=strftime(date_day,'%U') day_of_month:i=day(date_day) "
        "day_of_week:i=dayofweek(date_day)+1 day_of_year:i=dayofyear(date_day) "
        "month_name=monthname(date_day) month_short=strftime(date_day,'%b') day_name=dayname(date_day) "
        "day_short=strftime(date_day,'%a') year_month=strftime(date_day,'%Y-%m') "
        "year_quarter=year(date_day)||'-Q'||quarter(date_day) "
        "fiscal_year:i=year(date_day-INTERVAL'31'DAY) is_weekend=dayofweek(date_day)%6=0 "
        "is_holiday=strftime(date_day,'%m%d')IN('0101','0704','1225') " + DATE_FLAGS, "calendar"),
    "date_spine": ("date_day:d", "days"),
    "zero_fill_months": (
        "year_month month_name revenue:f=ifnull(sum(total_amount),0)",
        "(SELECT strftime(date_day, '%Y-%m') AS year_month, monthname(date_day) AS month_name, date_day AS d FROM calendar) "
        "LEFT JOIN fo ON order_date = d GROUP BY ALL"),
    "sum_by_month": ("order_month:i revenue:f=sum(total_amount)", "fo GROUP BY order_month"),
    "daily_source_mix": (
        DAILY_BOTH + "day_of_week:i canceled_order_count fully_delivered_count web_orders tiktok_orders", "daily"),
    "customer_status_mix": (
        CUSTOMER_SUMS + "first_orders order_sources=array_to_string(order_sources,',') refunded_orders "
        "canceled_orders avg_days_between_orders:f=span_days/nullif(total_orders-1,0) "
        "refund_rate:f=refunded_orders/total_orders", "history"),
    "product_discount_rate": (
        "product_id total_revenue:f total_discounts:f "
        "discount_rate:f=total_discounts/nullif(total_revenue+total_discounts,0)", "per_product"),
    "fct_line_items": (
        "line_item_id order_id product_id quantity unit_price:f line_total:f=line_total_before_discount", "sl"),
    "incremental_equals_full": (
        "order_id payment_status total_amount:f synced_at:t _daton_batch_id", "newest"),
    "stream_ingest": (
        "order_id payment_status total_amount:f synced_at:t _daton_batch_id", "newest"),
    "orders_scd2": (
        "order_id payment_status fulfillment_status cancellation_reason total_amount:f valid_from:t "
        "valid_to:t is_current", "order_changes"),
    "surrogate_keys": ("order_id line_item_id line_key=sha256(length(order_id)||':'||order_id||length(line_item_id)||':'||line_item_id)", "sl"),
    "check_unique": ("customer_id n_rows=count(*)", "fo GROUP BY customer_id HAVING count(*) > 1"),
    "check_not_null": ("order_id", "so WHERE customer_id IS NULL"),
    "check_not_null_where": ("order_id", "fo WHERE NOT is_canceled AND customer_id IS NULL"),
    "check_accepted_values": (
        "order_id payment_status", "so WHERE payment_status NOT IN ('paid', 'pending', 'authorized', 'voided')"),
    "check_relationships": ("order_id line_item_id", "sl ANTI JOIN so USING (order_id)"),
    "check_customers_have_orders": (
        "customer_id:s=c_custkey", "customer LEFT JOIN fo ON customer_id = c_custkey::VARCHAR WHERE order_id IS NULL"),
    "check_no_orders_lost": (
        "source_count target_count",
        "(SELECT (SELECT count(DISTINCT id) FROM raw_orders) AS source_count, (SELECT count(*) FROM so) AS target_count) "
        "WHERE source_count <> target_count"),
    "check_positive_total": ("order_id total_amount:f", "fo WHERE total_amount < 0"),
    "check_discount_le_subtotal": (
        "order_id subtotal_amount:f discount_amount:f", "fo WHERE discount_amount > subtotal_amount"),
    "check_expression": (
        "order_id discount_rate:f", "fo WHERE NOT (discount_rate < 0.1221 OR is_canceled)"),
    "check_freshness": (
        "max_loaded_at:t=max(ts) age_hours:i=datesub('hour',max(ts),TIMESTAMP'2024-02-01T06:00:00') "
        "status=CASE/**/WHEN/**/max(ts)<TIMESTAMP'2024-01-30T06:00:00'THEN'ERROR'"
        "WHEN/**/max(ts)<TIMESTAMP'2024-01-31T06:00:00'THEN'WARN'ELSE'PASS'END", "events"),
    "check_recency": (
        "most_recent:t", "(SELECT max(ts) AS most_recent FROM events) WHERE most_recent < TIMESTAMP '2024-01-31 06:00:00'"),
    "check_equal_rowcount": (
        "rows_a rows_b",
        "(SELECT (SELECT count(*) FROM raw_orders) AS rows_a, (SELECT count(*) FROM so) AS rows_b) WHERE rows_a <> rows_b"),
    "check_fewer_rows": (
        "rows_a rows_b",
        "(SELECT (SELECT count(*) FROM raw_orders) AS rows_a, (SELECT count(*) FROM so) AS rows_b) WHERE rows_a >= rows_b"),
    "check_at_least_one": ("n_values", "(SELECT count(order_closed_at) AS n_values FROM so WHERE payment_status = 'authorized') WHERE n_values = 0"),
    "check_between": ("order_id total_amount:f", "fo WHERE total_amount < 10 OR total_amount > 400"),
    "check_length": ("order_id customer_email", "so WHERE length(customer_email) NOT BETWEEN 5 AND 10"),
    "check_regex": (
        "order_id customer_email", "so WHERE NOT regexp_full_match(customer_email, 'c[0-8]+@[a-z]+\\.com')"),
    "check_row_count": ("n_rows", "(SELECT count(*) AS n_rows FROM so) WHERE n_rows NOT BETWEEN 1 AND 100"),
    "check_distinct_count": (
        "n_distinct", "(SELECT count(DISTINCT payment_status) AS n_distinct FROM so) WHERE n_distinct <> 5"),
}

for _side in ("first", "last"):
    SELECTS[f"{_side}_product"] = (
        f"order_id line_item_id customer_id {_side}_product",
        f"(SELECT order_id, line_item_id, customer_id, {_side}_value(product_title) OVER (PARTITION BY customer_id "
        f"ORDER BY sl.order_created_at, order_id, line_item_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) "
        f"AS {_side}_product FROM sl JOIN so USING (order_id) WHERE customer_id IS NOT NULL)")

# what increments and merges end with is what a rebuild makes of all rows
SELECTS["incremental_orders"] = SELECTS["fct_orders"]
SELECTS["incremental_daily_revenue"] = SELECTS["daily_revenue"]
SELECTS["incremental_customers"] = SELECTS["dim_customers"]
SELECTS["streamed_orders"] = SELECTS["fct_orders"]
SELECTS["streamed_daily_revenue"] = SELECTS["daily_revenue"]
SELECTS["streamed_customers"] = SELECTS["dim_customers"]
SELECTS["bucketed_latest_order"] = SELECTS["dedup_latest_order"]
SELECTS["orders_snapshot"] = SELECTS["orders_scd2"]
SELECTS["orders_current_state"] = (
    "order_id payment_status fulfillment_status cancellation_reason total_amount:f valid_from:t=synced_at", "newest")

SELECTS["monthly_customers"] = (
    "order_year:i order_month:i unique_customers=count(DISTINCT/**/customer_id) is_close=true",
    "fo WHERE NOT is_canceled GROUP BY ALL")
SELECTS["rejoined_totals"] = (
    "order_id n_rows=count(*) total_quantity:i=ifnull(sum(quantity),0) titled_rows=count(product_title) "
    "delivered_rows=count(*)FILTER(WHERE/**/shipment_status='delivered') tracked_rows=count(tracking_number) "
    "repeated_amount:f=sum(total_amount)",
    "(SELECT order_id, total_amount FROM so) LEFT JOIN (SELECT order_id, product_title, quantity FROM sl) USING (order_id) "
    "LEFT JOIN (SELECT order_id, tracking_number, shipment_status FROM ss) USING (order_id) GROUP BY order_id")

SELECTS["replaced_load"] = (
    "order_id=id _daton_batch_id financial_status loaded_rows=count(*)OVER()", "raw_orders")
SELECTS["replaced_lookup"] = (
    "country_code=lpad(n_nationkey::VARCHAR,4,'0') country_name=n_name region=r_name",
    "nation LEFT JOIN region ON r_regionkey = n_regionkey")
SELECTS["exported_csv"] = ("order_id:i order_created_at:t total_amount:f is_canceled referring_site", "fo")
SELECTS["orders_view"] = ("order_size_bucket n_orders=count(*) revenue:f=sum(total_amount)", "fo GROUP BY order_size_bucket")
SELECTS["required_customer"] = ("order_id=id _daton_batch_id customer_id=customer[1].id", "raw_orders WHERE len(customer) > 0")
SELECTS["times_of_rows"] = (
    "order_id customer_id order_created_at:t order_processed_at:t _daton_batch_id is_stamped=true",
    "typed WHERE customer_id IN (SELECT customer_id FROM dc)")

_PICKED = (
    "dc LEFT JOIN (SELECT customer_id, customer_email AS last_email, order_source AS latest_order_source, "
    "referring_site AS latest_referring_site FROM so QUALIFY row_number() OVER (PARTITION BY customer_id "
    "ORDER BY order_created_at DESC, order_id DESC) = 1) USING (customer_id) "
    "LEFT JOIN (SELECT customer_id, referring_site AS acquisition_referrer FROM so WHERE customer_order_sequence = 1) "
    "USING (customer_id)"
)
SELECTS["first_last_order_attrs"] = (
    CUSTOMER_DIM.replace("customer_email", "customer_email=last_email")
    + "avg_days_between_orders:f=span_days/nullif(total_orders-1,0) latest_order_source "
    "latest_referring_site acquisition_referrer refund_rate:f=refunded_orders/total_orders "
    "canceled_order_count=canceled_orders", _PICKED)

_STATEMENTS = {
    "dedup_rowcounts": """
SELECT 'raw' AS table_name, count(*) AS total_rows, count(DISTINCT id) AS unique_orders FROM raw_orders
UNION ALL SELECT 'staging', count(*), count(DISTINCT order_id) FROM so""",
    "dedup_revenue_compare": """
SELECT 'raw' AS source, round(sum(total_price::DOUBLE)::DECIMAL(38, 9), 6)::DOUBLE AS total_revenue FROM raw_orders
UNION ALL SELECT 'staging', round(sum(total_amount)::DECIMAL(38, 9), 6)::DOUBLE FROM so""",
    "dedup_monitor": """
SELECT entity, raw_rows, clean_rows, round(100 * (1 - clean_rows / raw_rows), 2) AS dedup_rate_pct FROM (
SELECT 'orders' AS entity, (SELECT count(*) FROM raw_orders) AS raw_rows, (SELECT count(*) FROM so) AS clean_rows
UNION ALL SELECT 'line_items', (SELECT count(*) FROM every_line), (SELECT count(*) FROM sl)
UNION ALL SELECT 'fulfillments', (SELECT count(*) FROM every_shipment), (SELECT count(*) FROM ss))""",
}

_STATEMENTS["check_whole_tables"] = f"""
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM (
SELECT 'freshness_raw_orders_timestamp_millis(bigint(_daton_batch_runtime))' AS check_name, 'raw_orders' AS table_name,
  CASE WHEN loaded < TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR OR loaded >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
    THEN 'error' ELSE 'warn' END AS severity, (loaded < TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR)::BIGINT AS failures
FROM (SELECT max(epoch_ms(_daton_batch_runtime::BIGINT)) AS loaded FROM raw_orders)
UNION ALL SELECT 'recency_fct_orders_order_created_at', 'fct_orders', 'warn',
  (SELECT (max(order_created_at) < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY)::BIGINT FROM fo)
UNION ALL SELECT 'distinct_source_lost_raw_orders_id', 'raw_orders', 'warn',
  ((SELECT count(DISTINCT id) FROM raw_orders) <> (SELECT count(*) FROM so))::BIGINT
UNION ALL SELECT 'without_children_dim_customers_customer_id', 'dim_customers', 'error',
  (SELECT count(*) FROM dc WHERE customer_id NOT IN (SELECT customer_id FROM fo WHERE customer_id IS NOT NULL))
UNION ALL SELECT 'equal_rowcount_fct_orders', 'fct_orders', 'error',
  ((SELECT count(*) FROM fo) <> (SELECT count(*) FROM so))::BIGINT
UNION ALL SELECT 'fewer_rows_dim_customers', 'dim_customers', 'warn',
  ((SELECT count(*) FROM dc) >= (SELECT count(*) FROM so))::BIGINT
UNION ALL SELECT 'at_least_one_dim_products_product_id', 'dim_products', 'error',
  (SELECT (count(product_id) = 0)::BIGINT FROM dp))"""



def _elements(array: str, fields: Iterable[str]) -> str:
    """All fields of an array's elements as one text."""
    shown = [f"strftime(e.{n}, '%Y-%m-%d %H:%M:%S')" if n in ("created_at", "updated_at") else f"e.{n}" for n in fields]
    each = ", ".join(f"coalesce({x}, '~')" for x in shown)
    return f"coalesce(array_to_string(list_transform({array}, lambda e: concat_ws('|', {each})), ';'), '')"


_SCANNED = (
    "order_id=id name order_number confirmation_number currency presentment_currency financial_status fulfillment_status "
    "cancel_reason source_name source_identifier referring_site email phone tags token app_id confirmed test taxes_included "
    "buyer_accepts_marketing _daton_user_id _daton_batch_id _daton_batch_runtime created_at:t processed_at:t updated_at:t "
    "closed_at:t cancelled_at:t subtotal_price:f total_discounts:f total_tax:f total_price:f total_line_items_price:f "
    "total_tip_received:f customers n_lines:i=len(line_items) lines line_prices:f line_discounts:f "
    "n_fulfillments:i=len(fulfillments) shipments"
)
_STATEMENTS["scan_jsonl"] = _select(_SCANNED, f"""(SELECT *, {_elements("customer", ["id"])} AS customers,
  {_elements("line_items", [n for n in LINE_ITEM_FIELDS if n not in ("price", "total_discount")])} AS lines,
  {_elements("fulfillments", FULFILLMENT_FIELDS)} AS shipments,
  ifnull(list_sum(list_transform(line_items, lambda e: e.price::DOUBLE)), 0) AS line_prices,
  ifnull(list_sum(list_transform(line_items, lambda e: e.total_discount::DOUBLE)), 0) AS line_discounts
FROM raw_orders)""")

# The declared checks, a line each. The values a column may have stand behind it,
# or the table whose key it points to; "warn" stands where a failure only warns.
_CHECKS = """
not_null raw_orders id
unique stg_orders order_id
not_null stg_orders order_id
not_null stg_orders customer_id
not_null stg_orders order_created_at
not_null stg_orders total_amount
accepted_values stg_orders payment_status paid pending refunded partially_refunded voided authorized
accepted_values stg_orders fulfillment_status fulfilled unfulfilled partial restocked
unique stg_line_items line_item_id
not_null stg_line_items line_item_id
not_null stg_line_items order_id
not_null stg_line_items product_title
not_null stg_line_items quantity
not_null stg_line_items unit_price
relationships stg_line_items order_id stg_orders
unique stg_fulfillments fulfillment_id
not_null stg_fulfillments fulfillment_id
not_null stg_fulfillments order_id
not_null stg_fulfillments fulfilled_at
relationships stg_fulfillments order_id stg_orders
unique int_orders_enriched order_id
not_null int_orders_enriched order_id
not_null int_orders_enriched customer_id
accepted_values int_orders_enriched order_size_bucket small medium large enterprise
unique int_customer_history customer_id
not_null int_customer_history customer_id
accepted_values int_customer_history frequency_segment one_time developing loyal champion
accepted_values int_customer_history recency_segment active cooling at_risk churned
accepted_values int_customer_history value_segment low_value medium_value high_value vip
unique fct_orders order_id
not_null fct_orders order_id
not_null fct_orders customer_id
not_null fct_orders order_date
not_null fct_orders total_amount
relationships fct_orders customer_id dim_customers
warn accepted_values fct_orders payment_status paid pending refunded voided partially_refunded authorized partially_paid
accepted_values fct_orders order_size_bucket small medium large enterprise
unique fct_daily_revenue order_date
not_null fct_daily_revenue order_date
unique dim_customers customer_id
not_null dim_customers customer_id
accepted_values dim_customers customer_tier platinum gold silver bronze
accepted_values dim_customers frequency_segment one_time developing loyal champion
accepted_values dim_customers recency_segment active cooling at_risk churned
accepted_values dim_customers value_segment low_value medium_value high_value vip
unique dim_products product_id
not_null dim_products product_id
accepted_values dim_products product_tier top_10 top_50 top_100 other
accepted_values dim_products product_status new active dormant
"""


def _check_sql(line: str) -> str:
    severity = "warn" if line.startswith("warn ") else "error"
    kind, model, column, *rest = line.removeprefix("warn ").split()
    table = MODEL_STEPS[model]
    if kind == "unique":
        failing = f"(SELECT 1 FROM {table} GROUP BY {column} HAVING count(*) > 1)"
    elif kind == "not_null":
        failing = f"{table} WHERE {column} IS NULL"
    elif kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in rest)
        failing = f"{table} WHERE {column} NOT IN ({listed})"
    else:
        failing = (
            f"{table} WHERE {column} IS NOT NULL AND NOT EXISTS "
            f"(FROM {MODEL_STEPS[rest[0]]} AS p WHERE p.{column} = {table}.{column})"
        )
    return (
        f"SELECT '{kind}_{model}_{column}' AS check_name, '{model}' AS table_name, '{column}' AS column_name, "
        f"'{severity}' AS severity, (SELECT count(*) FROM {failing}) AS failures"
    )


# The further checks; the failing rows of each stand last.
_FURTHER_CHECKS = (
    ("between_stg_orders_total_amount", "stg_orders", "total_amount", "total_amount < 0"),
    ("length_between_stg_orders_customer_email", "stg_orders", "customer_email", "length(customer_email) NOT BETWEEN 5 AND 255"),
    ("matches_stg_orders_customer_email", "stg_orders", "customer_email",
     r"NOT regexp_matches(customer_email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$')"),
    ("expression_fct_orders_total_amount >= 0", "fct_orders", None, "NOT total_amount >= 0"),
    ("expression_fct_orders_discount_amount <= subtotal_amount", "fct_orders", None, "NOT discount_amount <= subtotal_amount"),
    ("not_null_fct_orders_customer_id_is_canceled = FALSE", "fct_orders", "customer_id", "customer_id IS NULL AND NOT is_canceled"),
)


def _stored_check_sql() -> list[str]:
    """The checks that an incremental build keeps."""
    kept = ("stg_orders", "stg_line_items", "stg_fulfillments", "fct_orders", "fct_daily_revenue")
    lines = [x for x in _CHECKS.split("\n")[1:-1] if x.removeprefix("warn ").split()[1] in kept]
    lines += ["unique dim_customers customer_id", "not_null dim_customers customer_id"]
    further = [
        f"SELECT '{name}' AS check_name, '{model}' AS table_name, {repr(column) if column else 'NULL'} AS column_name, "
        f"'error' AS severity, (SELECT count(*) FROM {MODEL_STEPS[model]} WHERE {failing}) AS failures"
        for name, model, column, failing in _FURTHER_CHECKS
    ]
    return [*map(_check_sql, lines), *further]


def _check_metadata_sql() -> str:
    lines = [
        f"SELECT '{name}' AS check_name, '{model}' AS table_name, 'error' AS severity, {about} AS description, {owner} AS owner, "
        f"(SELECT count(*) FROM {MODEL_STEPS[model]} WHERE {failing}) AS failures"
        for name, model, _, failing in _FURTHER_CHECKS
        for about, owner in [("'An order''s discount is part of its subtotal'", "'order data'") if "discount" in name else ("NULL", "NULL")]
    ]
    return "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n" + "\nUNION ALL ".join(lines) + ")"


def oracle_sql() -> dict[str, str]:
    out = {name: _chain(_select(*parts)) for name, parts in SELECTS.items()}
    out |= {name: _chain(text.strip()) for name, text in _STATEMENTS.items()}
    suites = {"check_suite": map(_check_sql, _CHECKS.split("\n")[1:-1]), "incremental_checks": _stored_check_sql()}
    for name, parts in suites.items():
        suite = "\nUNION ALL ".join(parts)
        out[name] = _chain(
            "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            f"FROM (\n{suite})"
        )
    out["check_metadata"] = _chain(_check_metadata_sql())
    return out
