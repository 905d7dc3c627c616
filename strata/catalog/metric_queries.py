"""Metric queries (M01-M33, G01-G08, P01) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.catalog.prelude import oracle
from strata.catalog.sqlfrag import cents, money_avg, msum, ratio, round6, divide
from strata.plans import metrics as M
from strata.plans.analysis import inventory_value, metric_switch
from strata.plans.star import Where
from strata.sources.fixtures import retail_star

Q: dict = {}
SQL: dict = {}


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def ev(metrics, by, **kw):
    return lambda spark, sf: M.evaluate(retail_star(spark, sf), metrics, by, **kw)


LINE_PROD = "fact_sales_line_item l LEFT JOIN dim_product p ON l.product_id = p.product_id"
LINE_STORE = "fact_sales_line_item l LEFT JOIN dim_store s ON l.store_id = s.store_id"
TXN_STORE = "fact_sales_transaction t LEFT JOIN dim_store s ON t.store_id = s.store_id"
N_NET = msum("line_subtotal_cad")
N_COST = msum("line_cost_cad")

# --- M01-M04: the minimum slice -------------------------------------------------
Q["gross_margin_pct"] = ev(["net_sales", "total_cost", "gross_margin", "gross_margin_pct"], ["brand", "year"])
SQL["gross_margin_pct"] = oracle(f"""
SELECT brand, year, {cents('sn')} AS net_sales, {cents('sc')} AS total_cost, {cents('sn - sc')} AS gross_margin,
       {ratio('sn - sc', 'sn')} AS gross_margin_pct
FROM (SELECT p.brand, year(l.transaction_date) AS year, {N_NET} AS sn, {N_COST} AS sc
      FROM {LINE_PROD} GROUP BY 1, 2)""")

Q["net_sales"] = ev(["net_sales"], ["banner_name", "year"])
SQL["net_sales"] = oracle(f"""
SELECT s.banner_name, year(l.transaction_date) AS year, {cents(N_NET)} AS net_sales
FROM {LINE_STORE} GROUP BY 1, 2""")

Q["total_cost"] = ev(["total_cost"], ["category_name"])
SQL["total_cost"] = oracle(f"""
SELECT p.category_name, {cents(N_COST)} AS total_cost FROM {LINE_PROD} GROUP BY 1""")

# snowflake attribute: banner_category is reached through dim_store -> dim_banner
Q["gross_margin"] = ev(["gross_margin"], ["banner_category", "year"])
SQL["gross_margin"] = oracle(f"""
SELECT banner_category, year, {cents('sn - sc')} AS gross_margin FROM (
  SELECT b.banner_category, year(l.transaction_date) AS year, {N_NET} AS sn, {N_COST} AS sc
  FROM fact_sales_line_item l LEFT JOIN (SELECT s.store_id, b.banner_category FROM dim_store s
       LEFT JOIN dim_banner b ON s.banner_id = b.banner_id) b ON l.store_id = b.store_id
  GROUP BY 1, 2)""")

# --- M05-M09 --------------------------------------------------------------------
Q["revenue_incl_tax"] = ev(["revenue_incl_tax"], ["channel", "year"])
SQL["revenue_incl_tax"] = oracle(f"""
SELECT channel, year(transaction_date) AS year, {cents(msum('total_amount_cad'))} AS revenue_incl_tax
FROM fact_sales_transaction GROUP BY 1, 2""")

Q["transactions"] = ev(["transactions"], ["banner_name", "month"])
SQL["transactions"] = oracle(f"""
SELECT s.banner_name, CAST(date_trunc('month', t.transaction_date) AS DATE) AS month,
       count(DISTINCT t.transaction_id) AS transactions
FROM {TXN_STORE} GROUP BY 1, 2""")

Q["units"] = ev(["units"], ["category_name", "year"])
SQL["units"] = oracle(f"""
SELECT p.category_name, year(l.transaction_date) AS year, CAST(sum(l.quantity) AS BIGINT) AS units
FROM {LINE_PROD} GROUP BY 1, 2""")

Q["avg_txn_value"] = ev(["avg_txn_value"], ["channel"])
SQL["avg_txn_value"] = oracle(f"""
SELECT channel, {money_avg(msum('total_amount_cad'), 'count(DISTINCT transaction_id)')} AS avg_txn_value
FROM fact_sales_transaction GROUP BY 1""")

# drill-across: units from lines, transactions from the transaction fact
Q["units_per_txn"] = ev(["units", "transactions", "units_per_txn"], ["banner_name", "year"])
SQL["units_per_txn"] = oracle(f"""
SELECT coalesce(a.banner_name, b.banner_name) AS banner_name, coalesce(a.year, b.year) AS year,
       CAST(a.u AS BIGINT) AS units, b.n AS transactions, {ratio('a.u', 'b.n')} AS units_per_txn
FROM (SELECT s.banner_name, year(l.transaction_date) AS year, sum(l.quantity) AS u FROM {LINE_STORE} GROUP BY 1, 2) a
FULL JOIN (SELECT s.banner_name, year(t.transaction_date) AS year, count(DISTINCT t.transaction_id) AS n
           FROM {TXN_STORE} GROUP BY 1, 2) b
  ON a.banner_name IS NOT DISTINCT FROM b.banner_name AND a.year IS NOT DISTINCT FROM b.year""")

# --- M13-M22 --------------------------------------------------------------------
Q["active_customers"] = ev(["active_customers"], ["year"])
SQL["active_customers"] = oracle("""
SELECT year(transaction_date) AS year, count(DISTINCT customer_id) AS active_customers
FROM fact_sales_transaction GROUP BY 1""")

Q["loyalty_txns"] = ev(["loyalty_txns"], ["channel", "year"])
SQL["loyalty_txns"] = oracle("""
SELECT channel, year(transaction_date) AS year,
       count(DISTINCT CASE WHEN is_loyalty_transaction = 1 THEN transaction_id END) AS loyalty_txns
FROM fact_sales_transaction GROUP BY 1, 2""")

Q["loyalty_txn_pct"] = ev(["loyalty_txn_pct"], ["banner_name"])
SQL["loyalty_txn_pct"] = oracle(f"""
SELECT s.banner_name, {ratio('count(DISTINCT CASE WHEN t.is_loyalty_transaction = 1 THEN t.transaction_id END)',
                             'count(DISTINCT t.transaction_id)')} AS loyalty_txn_pct
FROM {TXN_STORE} GROUP BY 1""")

Q["loyalty_members"] = ev(["loyalty_members"], ["loyalty_tier", "segment"])
SQL["loyalty_members"] = oracle("""
SELECT loyalty_tier, segment, count(DISTINCT customer_business_key) AS loyalty_members
FROM dim_customer GROUP BY 1, 2""")

Q["points_earned"] = ev(["points_earned", "points_redeemed"], ["event_type"])
SQL["points_earned"] = oracle("""
SELECT event_type, CAST(sum(CASE WHEN points_delta > 0 THEN points_delta END) AS BIGINT) AS points_earned,
       CAST(-sum(CASE WHEN points_delta < 0 THEN points_delta END) AS BIGINT) AS points_redeemed
FROM fact_loyalty_event GROUP BY 1""")

Q["redemption_rate"] = ev(["points_earned", "points_redeemed", "redemption_rate"], ["loyalty_tier"])
SQL["redemption_rate"] = oracle(f"""
SELECT loyalty_tier, CAST(e AS BIGINT) AS points_earned, CAST(r AS BIGINT) AS points_redeemed,
       {ratio('r', 'e')} AS redemption_rate
FROM (SELECT c.loyalty_tier, sum(CASE WHEN points_delta > 0 THEN points_delta END) AS e,
             -sum(CASE WHEN points_delta < 0 THEN points_delta END) AS r
      FROM fact_loyalty_event f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY 1)""")

Q["avg_lifetime_spend"] = ev(["avg_lifetime_spend"], ["loyalty_tier"])
SQL["avg_lifetime_spend"] = oracle(f"""
SELECT loyalty_tier, {money_avg(msum('lifetime_spend_cad'), 'count(lifetime_spend_cad)')} AS avg_lifetime_spend
FROM dim_customer GROUP BY 1""")

Q["cross_shop_pct"] = ev(["cross_shop_pct"], ["segment"])
SQL["cross_shop_pct"] = oracle(f"""
SELECT segment, {ratio('count(DISTINCT CASE WHEN is_cross_category = 1 THEN customer_business_key END)',
                       'count(DISTINCT customer_business_key)')} AS cross_shop_pct
FROM dim_customer GROUP BY 1""")

_X1 = "CASE WHEN is_cross_category = 1 THEN lifetime_spend_cad END"
_X0 = "CASE WHEN coalesce(is_cross_category, 0) = 0 THEN lifetime_spend_cad END"
Q["cross_shop_multiple"] = ev(["cross_shop_multiple"], ["loyalty_tier"])
SQL["cross_shop_multiple"] = oracle(f"""
SELECT loyalty_tier, {round6(divide(divide(msum(_X1), f'count({_X1})'), divide(msum(_X0), f'count({_X0})')))}
       AS cross_shop_multiple
FROM dim_customer GROUP BY 1""")

# --- M23-M29 --------------------------------------------------------------------
_OWN = "CASE WHEN p.is_own_brand = 1 THEN l.line_subtotal_cad END"
Q["own_brand_sales"] = ev(["own_brand_sales"], ["banner_name", "year"])
SQL["own_brand_sales"] = oracle(f"""
SELECT s.banner_name, year(l.transaction_date) AS year, {cents(msum(_OWN))} AS own_brand_sales
FROM fact_sales_line_item l LEFT JOIN dim_product p ON l.product_id = p.product_id
     LEFT JOIN dim_store s ON l.store_id = s.store_id GROUP BY 1, 2""")

Q["own_brand_mix"] = ev(["own_brand_mix"], ["category_name"])
SQL["own_brand_mix"] = oracle(f"""
SELECT p.category_name, {ratio(msum(_OWN), msum('l.line_subtotal_cad'))} AS own_brand_mix
FROM {LINE_PROD} GROUP BY 1""")

Q["distinct_skus"] = ev(["distinct_skus"], ["banner_name", "year"])
SQL["distinct_skus"] = oracle(f"""
SELECT s.banner_name, year(l.transaction_date) AS year, count(DISTINCT l.product_id) AS distinct_skus
FROM {LINE_STORE} GROUP BY 1, 2""")

_DISC = msum("quantity * unit_discount_cad")
Q["discount_amount"] = ev(["discount_amount"], ["year"])
SQL["discount_amount"] = oracle(f"""
SELECT year(transaction_date) AS year, {cents(_DISC)} AS discount_amount FROM fact_sales_line_item GROUP BY 1""")

Q["promo_sales"] = ev(["promo_sales"], ["banner_name"])
SQL["promo_sales"] = oracle(f"""
SELECT s.banner_name, {cents(msum('CASE WHEN l.promotion_id IS NOT NULL THEN l.line_subtotal_cad END'))} AS promo_sales
FROM {LINE_STORE} GROUP BY 1""")

Q["markdown_rate"] = ev(["markdown_rate"], ["category_name", "year"])
SQL["markdown_rate"] = oracle(f"""
SELECT category_name, year, {ratio('d', 'n + d')} AS markdown_rate FROM (
  SELECT p.category_name, year(l.transaction_date) AS year, {msum('l.quantity * l.unit_discount_cad')} AS d,
         {msum('l.line_subtotal_cad')} AS n
  FROM {LINE_PROD} GROUP BY 1, 2)""")

Q["list_amount"] = ev(["list_amount"], ["brand"])
SQL["list_amount"] = oracle(f"""
SELECT p.brand, {cents(msum('l.quantity * l.unit_list_price_cad'))} AS list_amount FROM {LINE_PROD} GROUP BY 1""")

# --- M30-M33: inventory ---------------------------------------------------------
INV_STORE = "fact_inventory_snapshot i LEFT JOIN dim_store s ON i.store_id = s.store_id"
Q["on_hand_units"] = ev(["on_hand_units"], ["banner_name", "year"])
SQL["on_hand_units"] = oracle(f"""
SELECT s.banner_name, year(i.snapshot_date) AS year, CAST(sum(i.on_hand_units) AS BIGINT) AS on_hand_units
FROM {INV_STORE} GROUP BY 1, 2""")


@q("inventory_value", oracle(f"""
SELECT banner_name, year, {cents('arg_max(v, snapshot_date)')} AS inventory_value FROM (
  SELECT s.banner_name, year(i.snapshot_date) AS year, i.snapshot_date, {msum('i.inventory_value_cad')} AS v
  FROM {INV_STORE} GROUP BY 1, 2, 3) GROUP BY 1, 2"""))
def _inventory_value(spark, sf):
    return inventory_value(retail_star(spark, sf), ["banner_name", "year"])


Q["out_of_stock_rate"] = ev(["out_of_stock_rate"], ["category_name"])
SQL["out_of_stock_rate"] = oracle(f"""
SELECT p.category_name, {ratio('count(*) FILTER (WHERE i.is_out_of_stock = 1)', 'count(*)')} AS out_of_stock_rate
FROM fact_inventory_snapshot i LEFT JOIN dim_product p ON i.product_id = p.product_id GROUP BY 1""")

Q["avg_days_supply"] = ev(["avg_days_supply"], ["banner_name"])
SQL["avg_days_supply"] = oracle(f"""
SELECT s.banner_name, {ratio('sum(i.days_of_supply)', 'count(i.days_of_supply)')} AS avg_days_supply
FROM {INV_STORE} GROUP BY 1""")

# --- G08: totals and subtotals (re-aggregated per grouping set) -----------------
Q["metric_rollup"] = ev(["net_sales", "transactions", "gross_margin_pct", "units_per_txn"],
                        ["province_code", "banner_name"], grouping="rollup")
SQL["metric_rollup"] = oracle(f"""
SELECT coalesce(a.province_code, b.province_code) AS province_code,
       coalesce(a.banner_name, b.banner_name) AS banner_name, coalesce(a.g, b.g) AS grouping_id,
       {cents('a.sn')} AS net_sales, b.n AS transactions, {ratio('a.sn - a.sc', 'a.sn')} AS gross_margin_pct,
       {ratio('a.u', 'b.n')} AS units_per_txn
FROM (SELECT s.province_code, s.banner_name, CAST(grouping(s.province_code, s.banner_name) AS BIGINT) AS g,
             {N_NET} AS sn, {N_COST} AS sc, sum(l.quantity) AS u
      FROM {LINE_STORE} GROUP BY ROLLUP (s.province_code, s.banner_name)) a
FULL JOIN (SELECT s.province_code, s.banner_name, CAST(grouping(s.province_code, s.banner_name) AS BIGINT) AS g,
                  count(DISTINCT t.transaction_id) AS n
           FROM {TXN_STORE} GROUP BY ROLLUP (s.province_code, s.banner_name)) b
  ON a.province_code IS NOT DISTINCT FROM b.province_code AND a.banner_name IS NOT DISTINCT FROM b.banner_name
     AND a.g = b.g""")


# --- P01: field parameter, every selectable metric as rows ----------------------
@q("metric_switch", oracle(f"""
SELECT year, metric, metric_order, value FROM (
  SELECT coalesce(a.year, b.year) AS year,
         {cents('a.sn')} AS "Net Sales", {cents('a.sn - a.sc')} AS "Gross Margin",
         {ratio('a.sn - a.sc', 'a.sn')} AS "Gross Margin %", CAST(b.n AS DOUBLE) AS "Total Transactions",
         {money_avg('b.sr', 'b.n')} AS "Avg Transaction Value", {ratio('a.u', 'b.n')} AS "Units per Transaction",
         CAST(b.na AS DOUBLE) AS "Active Customers", {ratio('a.so', 'a.sn')} AS "Own-Brand Mix %"
  FROM (SELECT year(l.transaction_date) AS year, {msum('l.line_subtotal_cad')} AS sn, {msum('l.line_cost_cad')} AS sc,
               sum(l.quantity) AS u, {msum(_OWN)} AS so
        FROM {LINE_PROD} GROUP BY 1) a
  FULL JOIN (SELECT year(transaction_date) AS year, count(DISTINCT transaction_id) AS n,
                    count(DISTINCT customer_id) AS na, {msum('total_amount_cad')} AS sr
             FROM fact_sales_transaction GROUP BY 1) b ON a.year IS NOT DISTINCT FROM b.year
) UNPIVOT (value FOR metric IN ("Net Sales", "Gross Margin", "Gross Margin %", "Total Transactions",
                                "Avg Transaction Value", "Units per Transaction", "Active Customers",
                                "Own-Brand Mix %"))
JOIN (VALUES ('Net Sales', 0), ('Gross Margin', 1), ('Gross Margin %', 2), ('Total Transactions', 3),
             ('Avg Transaction Value', 4), ('Units per Transaction', 5), ('Active Customers', 6),
             ('Own-Brand Mix %', 7)) AS o(metric, metric_order) USING (metric)"""))
def _metric_switch(spark, sf):
    return metric_switch(retail_star(spark, sf), ["year"])

# --- F01: filters on an attribute and a period that are not grouped; M18 under its own key ----------
@q("metric_filtered")
def _metric_filtered(spark, sf):
    return M.evaluate(retail_star(spark, sf), ["net_sales", "transactions"], ["banner_name"], where=[
        Where(("province_code",), F.col("province_code").isin("ASIA", "EUROPE")),
        Where(("year",), F.col("year") == 1998)])


SQL["metric_filtered"] = oracle(f"""
SELECT coalesce(a.banner_name, b.banner_name) AS banner_name, {cents('a.sn')} AS net_sales, b.n AS transactions
FROM (SELECT s.banner_name, {N_NET} AS sn FROM {LINE_STORE}
      WHERE s.province_code IN ('ASIA', 'EUROPE') AND year(l.transaction_date) = 1998 GROUP BY 1) a
FULL JOIN (SELECT s.banner_name, count(DISTINCT t.transaction_id) AS n FROM {TXN_STORE}
      WHERE s.province_code IN ('ASIA', 'EUROPE') AND year(t.transaction_date) = 1998 GROUP BY 1) b
  ON a.banner_name IS NOT DISTINCT FROM b.banner_name""")

Q["points_redeemed"] = ev(["points_redeemed"], ["event_type", "year"])
SQL["points_redeemed"] = oracle("""
SELECT event_type, year(event_date) AS year, CAST(-sum(CASE WHEN points_delta < 0 THEN points_delta END) AS BIGINT)
         AS points_redeemed
FROM fact_loyalty_event GROUP BY 1, 2""")

# --- E08: the calendar as a dimension of every fact --------------------------------------------
Q["net_sales_fiscal"] = ev(["net_sales"], ["fiscal_year", "fiscal_quarter"])
SQL["net_sales_fiscal"] = oracle(f"""
SELECT CAST(year(transaction_date) + CASE WHEN month(transaction_date) >= 4 THEN 1 ELSE 0 END AS BIGINT) AS fiscal_year,
       concat('FQ', CASE WHEN month(transaction_date) < 4 THEN 4 ELSE quarter(transaction_date) - 1 END) AS fiscal_quarter,
       {cents(N_NET)} AS net_sales
FROM fact_sales_line_item GROUP BY 1, 2""")

Q["net_sales_weekend"] = ev(["net_sales", "transactions"], ["is_weekend"])
SQL["net_sales_weekend"] = oracle(f"""
SELECT a.is_weekend, {cents('a.sn')} AS net_sales, b.n AS transactions
FROM (SELECT CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, {N_NET} AS sn
      FROM fact_sales_line_item GROUP BY 1) a
JOIN (SELECT CASE WHEN isodow(transaction_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
             count(DISTINCT transaction_id) AS n
      FROM fact_sales_transaction GROUP BY 1) b ON a.is_weekend = b.is_weekend""")
