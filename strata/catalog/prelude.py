"""The retail star as DuckDB CTEs over the pre-registered test tables.

Spelled to match ``strata.sources.fixtures`` row for row; oracle queries are
``WITH <these>, ... SELECT ...``.
"""

from strata.catalog.sqlfrag import cents, msum

STAR_CTES = f"""
dim_banner AS (
  SELECT n_nationkey AS banner_id, n_name AS banner_name, r_name AS banner_category
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_store AS (
  SELECT s_suppkey AS store_id, s_name AS store_number, banner_id, banner_name, banner_category AS province_code
  FROM supplier JOIN dim_banner ON s_nationkey = banner_id),
dim_product AS (
  SELECT p_partkey AS product_id, concat('SKU-', CAST(p_partkey AS VARCHAR)) AS sku, p_name AS product_name,
         p_brand AS brand, p_type AS category_name, p_retailprice AS list_price_cad,
         round(p_retailprice * CAST(60 + p_size AS DOUBLE) / 100.0::DOUBLE * 100.0::DOUBLE) / 100.0::DOUBLE AS cost_price_cad,
         CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 1 ELSE 0 END AS is_own_brand
  FROM part),
cust_orders AS (
  SELECT o_custkey AS c_custkey, CAST(min(o_orderdate) AS DATE) AS enrollment_date,
         {cents(msum('o_totalprice'))} AS lifetime_spend_cad
  FROM orders GROUP BY o_custkey),
dim_customer AS (
  SELECT c.c_custkey AS customer_id, c_name AS customer_business_key, c_mktsegment AS segment,
         CASE WHEN c_acctbal < 2000 THEN 'Bronze' WHEN c_acctbal < 6000 THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
         enrollment_date, CAST(date_trunc('month', enrollment_date) AS DATE) AS enrollment_month,
         lifetime_spend_cad,
         CASE WHEN c.c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_cross_category
  FROM customer c LEFT JOIN cust_orders co ON c.c_custkey = co.c_custkey),
fact_sales_transaction AS (
  SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
         CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         o_orderkey % (SELECT count(*) FROM supplier) AS store_id, o_orderpriority AS channel,
         o_totalprice AS total_amount_cad,
         CASE WHEN o_custkey % 10 <> 0 AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS is_loyalty_transaction
  FROM orders),
fact_sales_line_item AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_number, CAST(l_shipdate AS DATE) AS transaction_date,
         l_suppkey AS store_id, l_partkey AS product_id, t.customer_id,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS unit_list_price_cad,
         l_extendedprice * l_discount / l_quantity AS unit_discount_cad,
         l_extendedprice * (1 - l_discount) AS line_subtotal_cad,
         l_quantity * p_retailprice AS line_cost_cad,
         CASE WHEN l_discount > 0 THEN CAST(round(l_discount * 100) AS INTEGER) END AS promotion_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN fact_sales_transaction t ON l_orderkey = t.transaction_id),
fact_inventory_snapshot AS (
  SELECT last_day(transaction_date) AS snapshot_date, store_id, product_id,
         CAST(sum(quantity) AS BIGINT) AS on_hand_units,
         {cents(msum('line_cost_cad'))} AS inventory_value_cad,
         CAST(sum(quantity) AS BIGINT) % 30 AS days_of_supply,
         CASE WHEN sum(quantity) < 5 THEN 1 ELSE 0 END AS is_out_of_stock
  FROM fact_sales_line_item GROUP BY last_day(transaction_date), store_id, product_id),
fact_loyalty_event AS (
  SELECT event_id AS loyalty_event_id, CAST(ts AS DATE) AS event_date, user_id AS customer_id, event_type,
         CAST(CASE event_type WHEN 'purchase' THEN floor(value) WHEN 'error' THEN -floor(value / 3) ELSE 0 END AS BIGINT)
           AS points_delta
  FROM events),
cal_ends AS (
  SELECT min(a) AS first_day, max(z) AS last_day FROM (
    SELECT min(transaction_date) AS a, max(transaction_date) AS z FROM fact_sales_transaction
    UNION ALL SELECT min(transaction_date), max(transaction_date) FROM fact_sales_line_item
    UNION ALL SELECT min(snapshot_date), max(snapshot_date) FROM fact_inventory_snapshot
    UNION ALL SELECT min(event_date), max(event_date) FROM fact_loyalty_event)),
cal AS (
  SELECT CAST(d AS DATE) AS date, CAST(date_trunc('month', d) AS DATE) AS month
  FROM (SELECT unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM cal_ends))
"""


def oracle(body: str, extra: str = "") -> str:
    """``WITH`` the star CTEs (plus ``extra`` CTEs) around a final SELECT."""
    ctes = STAR_CTES.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip().rstrip(",")
    return f"WITH {ctes}\n{body.strip()}"
