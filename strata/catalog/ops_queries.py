"""Sources, control tables, calendar, star joins, security, KPI series,
streaming pick-up and the layered run (A01-A14, B01-B09, E08/E09, R01-R04,
M55, M58-M60, S01) with their DuckDB oracles."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.catalog.history_queries import FIX_CTES, ORDER_COLS, OC
from strata.catalog.prelude import oracle
from strata.catalog.sqlfrag import cents, divide, money_avg, msum, ratio, round6
from strata.operators import merge as MG
from strata.operators import quality as DQ
from strata.operators import security as S
from strata.plans import kpi as K
from strata.plans import metrics as M
from strata.sources import control as C
from strata.sources import fixtures as FX
from strata.sources import landing as L
from strata.sources.calendar import calendar_for
from strata.sources.tables import read_if_exists, read_source, read_table, table_path

Q: dict = {}
SQL: dict = {}

LANDED_SQL = f"""landed AS (SELECT {OC}, CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN DATE '2000-12-31'
                   ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS Processing_Date FROM orders)"""
WM = "2001-03-01"


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select(*ORDER_COLS)


def _landed(spark, sf):
    return FX.order_batches(_orders(spark, sf))


_LANDING: dict = {}


def _landing_table(spark, sf):
    """The landed order batches as a real landing table (Parquet partitioned
    by Processing_Date), written once per session under the checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDING:
        path = os.path.join(_scratch(spark), "landing_orders")
        L.write_landing(_landed(spark, sf), path)
        _LANDING[key] = path
    return spark.read.parquet(_LANDING[key]).select(*ORDER_COLS, "Processing_Date")


def _star(spark, sf):
    return FX.retail_star(spark, sf)


# --- A01-A06, A09 ------------------------------------------------------------------
Q["read_source"] = lambda spark, sf: read_source(spark, table_path(sf, "orders")).select(*ORDER_COLS)
SQL["read_source"] = f"SELECT {OC} FROM orders"


def _land_batch(spark, sf):
    """The bulk batch stamped with its date plus the monthly increments."""
    o = _orders(spark, sf)
    bulk = L.stamp(FX.upsert_target(o), "2000-12-31", landed_at=False)
    inc = FX.order_batches(o).where(F.col("Processing_Date") > F.lit("2000-12-31").cast("date"))
    return bulk.unionByName(inc).groupBy("Processing_Date").agg(F.count(F.lit(1)).alias("rows"))


Q["land_batch"] = _land_batch
SQL["land_batch"] = f"WITH {LANDED_SQL} SELECT Processing_Date, count(*) AS rows FROM landed GROUP BY 1"

def _guarded_scan(spark, sf):
    """Tables that exist and hold rows of the year asked for; a table that
    does not exist yet, or a year without rows, yields nothing and no failure."""
    found = [(n, y, read_if_exists(spark, table_path(sf, n))) for n in ("orders", "returns") for y in (1995, 2050)]
    parts = [t.where(F.year("o_orderdate") == y).groupBy(F.lit(n).alias("table_name"), F.year("o_orderdate").alias("year"))
             .agg(F.count(F.lit(1)).alias("n_rows")) for n, y, t in found if t is not None]
    return reduce(DataFrame.unionByName, parts)


Q["guarded_scan"] = _guarded_scan
SQL["guarded_scan"] = """SELECT 'orders' AS table_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows
FROM orders WHERE year(o_orderdate) IN (1995, 2050) GROUP BY 2"""

Q["land_daily"] = lambda spark, sf: L.land_daily(_orders(spark, sf), "o_orderdate", "1998-06-15")
SQL["land_daily"] = f"""SELECT {OC}, DATE '1998-06-15' AS Processing_Date FROM orders
WHERE CAST(o_orderdate AS DATE) = DATE '1998-06-15'"""

Q["land_dim_changes"] = lambda spark, sf: L.land_dim_changes(
    spark, FX.product_changes(read_table(spark, sf, "part")).drop("Processing_Date"), "1998-03-01").select(
    "table_name", "business_key", "attribute", "old_value", "new_value", "Processing_Date")
SQL["land_dim_changes"] = oracle("""
SELECT 'dim_product' AS table_name, business_key, attribute, CAST(NULL AS VARCHAR) AS old_value, new_value,
       DATE '1998-03-01' AS Processing_Date FROM pchg""", FIX_CTES)

Q["new_since_watermark"] = lambda spark, sf: L.new_since(_landing_table(spark, sf), WM)
SQL["new_since_watermark"] = f"WITH {LANDED_SQL} SELECT * FROM landed WHERE Processing_Date > DATE '{WM}'"


def _evolve(spark, sf):
    o = _orders(spark, sf)
    bulk = FX.upsert_target(o)
    inc = o.where(F.col("o_orderdate") >= F.lit(FX.BULK_END).cast("timestamp_ntz")).withColumn(
        "o_channel", F.lower("o_orderpriority"))
    return MG.union_evolving(bulk, inc)


Q["schema_evolve_append"] = _evolve
SQL["schema_evolve_append"] = f"""
SELECT {OC}, CAST(NULL AS VARCHAR) AS o_channel FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
UNION ALL SELECT {OC}, lower(o_orderpriority) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'"""


# --- A10 / B04: registry with the size of each registered table ---------------------------
def _registry(spark, sf):
    star = _star(spark, sf)
    counts = None
    for name in ("dim_store", "dim_product", "dim_customer", "fact_sales_transaction", "fact_sales_line_item",
                 "fact_inventory_snapshot", "fact_loyalty_event", "dim_banner"):
        c = star.table(name).agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    reg = C.registry(spark)
    return reg.join(counts, "table_name", "left").select("table_name", "table_type", "is_scd2", "load_order",
                                                         "row_count")


_REG_ROWS = ", ".join(f"('{n}', '{t}', {str(s).lower()}, {o})" for n, t, _, s, _, o in C.REGISTRY)
Q["registry"] = _registry
SQL["registry"] = oracle(f"""
SELECT r.table_name, r.table_type, r.is_scd2, r.load_order, c.row_count
FROM (VALUES {_REG_ROWS}) r(table_name, table_type, is_scd2, load_order)
LEFT JOIN (SELECT 'dim_store' AS table_name, count(*) AS row_count FROM dim_store
           UNION ALL SELECT 'dim_product', count(*) FROM dim_product
           UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
           UNION ALL SELECT 'fact_sales_transaction', count(*) FROM fact_sales_transaction
           UNION ALL SELECT 'fact_sales_line_item', count(*) FROM fact_sales_line_item
           UNION ALL SELECT 'fact_inventory_snapshot', count(*) FROM fact_inventory_snapshot
           UNION ALL SELECT 'fact_loyalty_event', count(*) FROM fact_loyalty_event
           UNION ALL SELECT 'dim_banner', count(*) FROM dim_banner) c USING (table_name)""")


# --- B01-B03, B05-B08: watermark and audit -------------------------------------------------
def _wm_after_bulk(spark, sf):
    landed = _landed(spark, sf)
    first = landed.where(F.col("Processing_Date") <= F.lit(WM).cast("date"))
    return C.advance_watermark(None, spark, "bronze_fact_sales_transaction", first,
                               run_ts=F.lit(None)).select("table_name", "last_processing_date",
                                                          "last_run_timestamp", "last_rows_affected")


Q["watermark_read"] = lambda spark, sf: C.watermarks(_wm_after_bulk(spark, sf), C.registry(spark).union(
    spark.createDataFrame([("bronze_fact_sales_transaction", "fact", [], False, [], 99)], C.REGISTRY_SCHEMA)))
_REG_NAMES = ", ".join(f"('{n}')" for n, *_ in C.REGISTRY)
SQL["watermark_read"] = f"""
WITH {LANDED_SQL}
SELECT r.table_name, coalesce(w.m, '1900-01-01') AS watermark
FROM (VALUES {_REG_NAMES}, ('bronze_fact_sales_transaction')) r(table_name)
LEFT JOIN (SELECT 'bronze_fact_sales_transaction' AS table_name, CAST(max(Processing_Date) AS VARCHAR) AS m
           FROM landed WHERE Processing_Date <= DATE '{WM}') w USING (table_name)"""


def _wm_advance(spark, sf):
    wm = _wm_after_bulk(spark, sf)
    batch = L.new_since(_landing_table(spark, sf), C.read_watermark(wm, "bronze_fact_sales_transaction"))
    out = C.advance_watermark(wm, spark, "bronze_fact_sales_transaction", batch, run_ts=F.lit(None))
    return out.select("table_name", "last_processing_date", "last_rows_affected")


Q["watermark_advance"] = _wm_advance
SQL["watermark_advance"] = f"""
WITH {LANDED_SQL}
SELECT 'bronze_fact_sales_transaction' AS table_name, CAST(max(Processing_Date) AS VARCHAR) AS last_processing_date,
       count(*) AS last_rows_affected FROM landed WHERE Processing_Date > DATE '{WM}'"""


def _wm_seed(spark, sf):
    wm = _wm_after_bulk(spark, sf).withColumn("table_name", F.lit("fact_sales_transaction"))
    return C.seed_watermarks(wm, C.registry(spark)).select("table_name", "last_processing_date",
                                                            "last_rows_affected")


Q["watermark_seed"] = _wm_seed
SQL["watermark_seed"] = f"""
WITH {LANDED_SQL}
SELECT 'fact_sales_transaction' AS table_name, CAST(max(Processing_Date) AS VARCHAR) AS last_processing_date,
       count(*) AS last_rows_affected FROM landed WHERE Processing_Date <= DATE '{WM}'
UNION ALL
SELECT table_name, '1900-01-01', CAST(0 AS BIGINT) FROM (VALUES {_REG_NAMES}) r(table_name)
WHERE table_name <> 'fact_sales_transaction'"""


Q["audit_log"] = lambda spark, sf: C.audit_rows(_landed(spark, sf), "01_land", "landing", "orders", run_ts=None) \
    .drop("run_ts")
_AUDIT_SQL = f"""WITH {LANDED_SQL}
SELECT CAST(Processing_Date AS TIMESTAMP) AS run_ts, '01_land' AS notebook, 'landing' AS layer, 'orders' AS table_name,
       count(*) AS rows_affected, 'OK' AS status, 'pd=' || CAST(Processing_Date AS VARCHAR) AS message
FROM landed GROUP BY Processing_Date"""
SQL["audit_log"] = f"SELECT notebook, layer, table_name, rows_affected, status, message FROM ({_AUDIT_SQL})"


def _load_summary(spark, sf):
    landed = _landed(spark, sf)
    audit = C.audit_rows(landed, "01_land", "landing", "orders", run_ts=F.col("Processing_Date").cast("timestamp_ntz"))
    return C.load_summary(audit)


Q["load_summary"] = _load_summary
SQL["load_summary"] = f"SELECT * FROM ({_AUDIT_SQL}) ORDER BY run_ts DESC LIMIT 25"


def _next_day(spark, sf):
    o = read_table(spark, sf, "orders")
    w = o.agg(F.date_sub(F.max("o_orderdate").cast("date"), 9).alias("start"),
              F.max("o_orderdate").cast("date").alias("end"))
    return C.next_day(w.withColumn("wm", F.date_sub("end", 5)), F.col("wm"))


Q["next_day"] = _next_day
SQL["next_day"] = """
SELECT min(d) AS next_day FROM (SELECT CAST(max(o_orderdate) AS DATE) AS e FROM orders) b,
  LATERAL (SELECT CAST(g AS DATE) AS d FROM generate_series(b.e - INTERVAL 9 DAY, b.e, INTERVAL 1 DAY) t(g)) x
WHERE d > b.e - INTERVAL 5 DAY"""


def _last_refreshed(spark, sf):
    landed = _landed(spark, sf)
    audit = C.audit_rows(landed, "01_land", "landing", "orders", run_ts=F.col("Processing_Date").cast("timestamp_ntz"))
    return C.last_refreshed(audit)


Q["last_refreshed"] = _last_refreshed
SQL["last_refreshed"] = f"""SELECT 'Last refreshed: ' || strftime(max(run_ts), '%b %-d, %Y %-I:%M %p') AS label
FROM ({_AUDIT_SQL})"""

# --- A13: calendar ----------------------------------------------------------------------------
Q["dim_date"] = lambda spark, sf: calendar_for(_star(spark, sf).table("fact_sales_line_item"), "transaction_date")
_DOW = "isodow(d)"
SQL["dim_date"] = oracle(f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, {_DOW} AS day_of_week, dayname(d) AS day_of_week_name,
       dayofmonth(d) AS day_of_month, weekofyear(d) AS week_of_year, month(d) AS month_of_year, monthname(d) AS month_name,
       quarter(d) AS quarter, year(d) AS calendar_year, year(d) + CASE WHEN month(d) >= 4 THEN 1 ELSE 0 END AS fiscal_year,
       'FQ' || CAST(CAST(floor(((month(d) - 4 + 12) % 12) / 3) AS BIGINT) + 1 AS VARCHAR) AS fiscal_quarter,
       CASE WHEN {_DOW} >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN h IS NOT NULL THEN 1 ELSE 0 END AS is_canadian_holiday, h AS holiday_name,
       CASE WHEN {_DOW} = 5 AND (dayofmonth(d) BETWEEN 1 AND 7 OR dayofmonth(d) BETWEEN 15 AND 21) THEN 1 ELSE 0 END
         AS is_payday_friday
FROM (SELECT d, CASE
   WHEN month(d) = 1 AND dayofmonth(d) = 1 THEN 'New Year''s Day'
   WHEN month(d) = 7 AND dayofmonth(d) = 1 THEN 'Canada Day'
   WHEN month(d) = 11 AND dayofmonth(d) = 11 THEN 'Remembrance Day'
   WHEN month(d) = 12 AND dayofmonth(d) = 25 THEN 'Christmas Day'
   WHEN month(d) = 12 AND dayofmonth(d) = 26 THEN 'Boxing Day'
   WHEN month(d) = 2 AND {_DOW} = 1 AND dayofmonth(d) BETWEEN 15 AND 21 THEN 'Family Day'
   WHEN month(d) = 5 AND {_DOW} = 1 AND dayofmonth(d) BETWEEN 18 AND 24 THEN 'Victoria Day'
   WHEN month(d) = 8 AND {_DOW} = 1 AND dayofmonth(d) BETWEEN 1 AND 7 THEN 'Civic Holiday'
   WHEN month(d) = 9 AND {_DOW} = 1 AND dayofmonth(d) BETWEEN 1 AND 7 THEN 'Labour Day'
   WHEN month(d) = 10 AND {_DOW} = 1 AND dayofmonth(d) BETWEEN 8 AND 14 THEN 'Thanksgiving' END AS h
  FROM (SELECT CAST(g AS DATE) AS d FROM (SELECT min(transaction_date) AS a, max(transaction_date) AS b
        FROM fact_sales_line_item), LATERAL generate_series(a, b, INTERVAL 1 DAY) t(g)))""")


# --- E08 / E09: star and snowflake joins ---------------------------------------------------------
def _star_join(spark, sf):
    f = _star(spark, sf).frame(M.LINE, ["banner_name", "category_name", "brand", "loyalty_tier"])
    return f.select("transaction_id", "line_number", "store_id", "product_id", "customer_id", "banner_name",
                    "category_name", "brand", "loyalty_tier")


Q["star_join"] = _star_join
SQL["star_join"] = oracle("""
SELECT l.transaction_id, l.line_number, l.store_id, l.product_id, l.customer_id, s.banner_name, p.category_name,
       p.brand, c.loyalty_tier
FROM fact_sales_line_item l LEFT JOIN dim_store s ON l.store_id = s.store_id
LEFT JOIN dim_product p ON l.product_id = p.product_id LEFT JOIN dim_customer c ON l.customer_id = c.customer_id""")


def _snow(spark, sf):
    f = _star(spark, sf).frame(M.TXN, ["banner_category"])
    return f.select("transaction_id", "store_id", "banner_category")


Q["snowflake_join"] = _snow
SQL["snowflake_join"] = oracle("""
SELECT t.transaction_id, t.store_id, b.banner_category FROM fact_sales_transaction t
LEFT JOIN dim_store s ON t.store_id = s.store_id LEFT JOIN dim_banner b ON s.banner_id = b.banner_id""")

# --- R01-R04: security ------------------------------------------------------------------------
# The role parameters used on the test data, and the user map.
RLS_PROVINCE = "AMERICA"
RLS_CATEGORY = "ASIA"
USER_BANNERS = [("a@x", 0), ("a@x", 1), ("a@x", 2), ("a@x", 3), ("a@x", 4), ("b@x", 7)]

Q["rls_region"] = lambda spark, sf: M.evaluate(S.rls_region(_star(spark, sf), RLS_PROVINCE),
                                               ["net_sales", "transactions"], ["banner_name", "year"])
SQL["rls_region"] = oracle(f"""
SELECT coalesce(a.banner_name, b.banner_name) AS banner_name, coalesce(a.year, b.year) AS year,
       {cents('a.sn')} AS net_sales, b.n AS transactions
FROM (SELECT s.banner_name, year(l.transaction_date) AS year, {msum('l.line_subtotal_cad')} AS sn
      FROM fact_sales_line_item l JOIN dim_store s ON l.store_id = s.store_id WHERE s.province_code = '{RLS_PROVINCE}'
      GROUP BY 1, 2) a
FULL JOIN (SELECT s.banner_name, year(t.transaction_date) AS year, count(DISTINCT t.transaction_id) AS n
           FROM fact_sales_transaction t JOIN dim_store s ON t.store_id = s.store_id
           WHERE s.province_code = '{RLS_PROVINCE}' GROUP BY 1, 2) b
  ON a.banner_name IS NOT DISTINCT FROM b.banner_name AND a.year = b.year""")

Q["rls_banner"] = lambda spark, sf: M.evaluate(S.rls_banner(_star(spark, sf), RLS_CATEGORY),
                                               ["net_sales", "units"], ["store_number"])
SQL["rls_banner"] = oracle(f"""
SELECT s.store_number, {cents(msum('l.line_subtotal_cad'))} AS net_sales, CAST(sum(l.quantity) AS BIGINT) AS units
FROM fact_sales_line_item l JOIN dim_store s ON l.store_id = s.store_id
JOIN dim_banner b ON s.banner_id = b.banner_id WHERE b.banner_category = '{RLS_CATEGORY}' GROUP BY 1""")


def _rls_dyn(spark, sf):
    m = S.user_banner_map(spark, USER_BANNERS)
    return M.evaluate(S.rls_dynamic(_star(spark, sf), m, "a@x"), ["net_sales", "avg_txn_value"], ["banner_name"])


_UB = ", ".join(f"('{u}', {b})" for u, b in USER_BANNERS)
Q["rls_dynamic"] = _rls_dyn
SQL["rls_dynamic"] = oracle(f"""
SELECT coalesce(a.banner_name, b.banner_name) AS banner_name, {cents('a.sn')} AS net_sales,
       {money_avg('b.sr', 'b.n')} AS avg_txn_value
FROM (SELECT s.banner_name, {msum('l.line_subtotal_cad')} AS sn FROM fact_sales_line_item l
      JOIN dim_store s ON l.store_id = s.store_id WHERE s.banner_id IN (SELECT banner_id FROM ub WHERE user_email = 'a@x')
      GROUP BY 1) a
FULL JOIN (SELECT s.banner_name, {msum('t.total_amount_cad')} AS sr, count(DISTINCT t.transaction_id) AS n
           FROM fact_sales_transaction t JOIN dim_store s ON t.store_id = s.store_id
           WHERE s.banner_id IN (SELECT banner_id FROM ub WHERE user_email = 'a@x') GROUP BY 1) b
  ON a.banner_name IS NOT DISTINCT FROM b.banner_name""", f"ub AS (SELECT * FROM (VALUES {_UB}) v(user_email, banner_id))")


def _customer_pii(spark, sf):
    c = _star(spark, sf).table("dim_customer")
    cd = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.sha2(F.concat(F.lower("c_name"), F.lit("@mail")), 256).alias("email_hash"),
        F.sha2(F.col("c_custkey").cast("string"), 256).alias("phone_hash"),
        F.split("c_name", "#").getItem(0).alias("first_name"),
        F.split("c_name", "#").getItem(1).alias("last_name"),
        (F.lit(1940) + F.col("c_nationkey") * 2).alias("birth_year"),
        F.concat(F.lit("T"), (F.col("c_nationkey") % 10).cast("string"), F.lit("P 1J0")).alias("home_postal_code"))
    return c.join(cd, "customer_id", "left")


Q["ols_no_pii"] = lambda spark, sf: S.ols_drop(_customer_pii(spark, sf))
SQL["ols_no_pii"] = oracle("SELECT * FROM dim_customer")

# --- M58-M60: KPI cards and series ---------------------------------------------------------------
Q["kpi_cards"] = lambda spark, sf: K.kpi_cards(_star(spark, sf))


def _fmt(x, d):
    k = f"{10 ** d}.0::DOUBLE"
    return f"printf('%.{d}f', round(({x}) * {k}) / {k})"


def _short(v):
    return (f"CASE WHEN abs({v}) >= 1e9 THEN {_fmt(f'{v} / 1e9', 1)} || 'B' WHEN abs({v}) >= 1e6 "
            f"THEN {_fmt(f'{v} / 1e6', 1)} || 'M' WHEN abs({v}) >= 1e3 THEN {_fmt(f'{v} / 1e3', 1)} || 'K' "
            f"ELSE {_fmt(v, 0)} END")


def _chip(dl, kind):
    sign = f"CASE WHEN {dl} < 0 THEN '-' ELSE '+' END"
    body = (f"{sign} || {_fmt(f'abs({dl}) * 100.0::DOUBLE', 1)} || '% vs PY'" if kind == "pct"
            else f"{sign} || {_fmt(f'abs({dl})', 1)} || ' pts vs PY'")
    return f"CASE WHEN {dl} IS NULL THEN 'no PY data' ELSE {body} END"


def _yp(c, p):
    return round6(divide(f"coalesce({c}, 0) - ({p})", p))


def _dp(c, p):
    return f"CASE WHEN ({p}) IS NOT NULL THEN {round6(f'(coalesce({c}, 0) - ({p})) * 100')} END"


_CARD_V = {
    "ns": cents("{a}.sn"), "tx": "CAST({a}.n AS DOUBLE)", "atv": money_avg("{a}.sr", "{a}.n"),
    "gm": ratio("{a}.sn - {a}.sc", "{a}.sn"), "lp": ratio("{a}.nl", "{a}.n"), "upt": ratio("{a}.u", "{a}.n"),
}


def _cv(k, a):
    return _CARD_V[k].format(a=a)


_CARD_ROWS = [
    ("NET SALES", "'$' || " + _short(_cv("ns", "c")), _chip(_yp(_cv("ns", "c"), _cv("ns", "p")), "pct"),
     _yp(_cv("ns", "c"), _cv("ns", "p"))),
    ("TRANSACTIONS", _short(_cv("tx", "c")), _chip(_yp(_cv("tx", "c"), _cv("tx", "p")), "pct"),
     _yp(_cv("tx", "c"), _cv("tx", "p"))),
    ("AVG BASKET", "'$' || format('{:,.2f}', round(" + _cv("atv", "c") + " * 100.0::DOUBLE) / 100.0::DOUBLE)",
     _chip(_yp(_cv("atv", "c"), _cv("atv", "p")), "pct"), _yp(_cv("atv", "c"), _cv("atv", "p"))),
    ("GROSS MARGIN %", _fmt(_cv("gm", "c") + " * 100.0::DOUBLE", 1) + " || '%'",
     _chip(_dp(_cv("gm", "c"), _cv("gm", "p")), "pts"), _dp(_cv("gm", "c"), _cv("gm", "p"))),
    ("LOYALTY PENETRATION", _fmt(_cv("lp", "c") + " * 100.0::DOUBLE", 1) + " || '%'",
     _chip(_dp(_cv("lp", "c"), _cv("lp", "p")), "pts"), _dp(_cv("lp", "c"), _cv("lp", "p"))),
    ("UNITS / TRANSACTION", _fmt(_cv("upt", "c"), 2), _chip(_yp(_cv("upt", "c"), _cv("upt", "p")), "pct"),
     _yp(_cv("upt", "c"), _cv("upt", "p"))),
]
_YEARLY = f"""y AS (SELECT coalesce(a.year, b.year) AS year, a.sn, a.sc, a.u, b.n, b.nl, b.sr FROM
  (SELECT year(transaction_date) AS year, {msum('line_subtotal_cad')} AS sn, {msum('line_cost_cad')} AS sc,
          sum(quantity) AS u FROM fact_sales_line_item GROUP BY 1) a
  FULL JOIN (SELECT year(transaction_date) AS year, count(DISTINCT transaction_id) AS n,
                    count(DISTINCT CASE WHEN is_loyalty_transaction = 1 THEN transaction_id END) AS nl,
                    {msum('total_amount_cad')} AS sr FROM fact_sales_transaction GROUP BY 1) b ON a.year = b.year)"""
SQL["kpi_cards"] = oracle(" UNION ALL ".join(
    f"SELECT coalesce(c.year, p.year + 1) AS year, '{t}' AS card, {v} AS value_text, {ch} AS chip_text, "
    f"CASE WHEN ({d}) IS NOT NULL THEN ({d}) >= 0 END AS is_up FROM y c FULL JOIN y p ON c.year = p.year + 1 "
    "WHERE c.year IS NOT NULL OR p.year + 1 <= (SELECT year(last_day) FROM cal_ends)"
    for t, v, ch, d in _CARD_ROWS), _YEARLY)

_MONTHLY = f"""mo AS (SELECT coalesce(a.month, b.month) AS month, a.sn, a.sc, a.u, b.n, b.nl, b.sr FROM
  (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, {msum('line_subtotal_cad')} AS sn,
          {msum('line_cost_cad')} AS sc, sum(quantity) AS u FROM fact_sales_line_item GROUP BY 1) a
  FULL JOIN (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(DISTINCT transaction_id) AS n,
                    count(DISTINCT CASE WHEN is_loyalty_transaction = 1 THEN transaction_id END) AS nl,
                    {msum('total_amount_cad')} AS sr FROM fact_sales_transaction GROUP BY 1) b ON a.month = b.month),
ser AS (SELECT card, (year(month) - 2024) * 12 + month(month) AS idx, v FROM (
  {" UNION ALL ".join(f"SELECT '{t}' AS card, month, CAST({_cv(k, 'm')} AS DOUBLE) AS v FROM mo m"
                      for (t, _, _, _), k in zip(_CARD_ROWS, ["ns", "tx", "atv", "gm", "lp", "upt"]))}))"""


def _kpi_points_sql():
    x = ("188.0::DOUBLE + CASE WHEN mx_i - mn_i = 0 THEN 48.0::DOUBLE "
         "ELSE CAST(idx - mn_i AS DOUBLE) / CAST(mx_i - mn_i AS DOUBLE) * 96.0::DOUBLE END")
    y = ("84.0::DOUBLE - CASE WHEN mx_v - mn_v = 0 THEN 0.5::DOUBLE "
         "ELSE (v - mn_v) / (mx_v - mn_v) END * 50.0::DOUBLE")
    return oracle(f"""
SELECT card, string_agg(txt, ' ' ORDER BY idx) AS points, count(*) AS n_points, {_fmt('arg_max(y, idx)', 1)} AS last_y
FROM (SELECT card, idx, {_fmt(x, 1)} || ',' || {_fmt(y, 1)} AS txt, {y} AS y FROM (
        SELECT card, idx, v, min(idx) OVER w AS mn_i, max(idx) OVER w AS mx_i, min(v) OVER w AS mn_v,
               max(v) OVER w AS mx_v FROM ser WHERE v IS NOT NULL WINDOW w AS (PARTITION BY card)))
GROUP BY card""", _MONTHLY)


Q["kpi_points"] = lambda spark, sf: K.kpi_points(_star(spark, sf))
SQL["kpi_points"] = _kpi_points_sql()


def _gen(x):
    return f"CASE WHEN ({x}) = floor({x}) THEN CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR) ELSE CAST(({x}) AS VARCHAR) END"


def _kpi_spark_sql():
    x = ("round(CASE WHEN mx_i - mn_i = 0 THEN 50.0::DOUBLE ELSE CAST(idx - mn_i AS DOUBLE) / "
         "CAST(mx_i - mn_i AS DOUBLE) * 100.0::DOUBLE END * 10.0::DOUBLE) / 10.0::DOUBLE")
    y = "round((28.0::DOUBLE - v / mx_v * 26.0::DOUBLE) * 10.0::DOUBLE) / 10.0::DOUBLE"
    return oracle(f"""
SELECT card, CASE WHEN count(*) >= 2 AND max(mx_v) <> 0 THEN string_agg(txt, ' ' ORDER BY idx) END AS points,
       count(*) AS n_points
FROM (SELECT card, idx, mx_v, {_gen(x)} || ',' || {_gen(y)} AS txt FROM (
        SELECT card, idx, v, min(idx) OVER w AS mn_i, max(idx) OVER w AS mx_i, max(v) OVER w AS mx_v
        FROM ser WINDOW w AS (PARTITION BY card)) WHERE v IS NOT NULL)
GROUP BY card""", _MONTHLY)


Q["kpi_spark"] = lambda spark, sf: K.kpi_spark(_star(spark, sf))
SQL["kpi_spark"] = _kpi_spark_sql()


# --- S01: streaming pick-up ------------------------------------------------------------------
def _scratch(spark):
    from strata.session import checkpoint_dir
    d = os.path.join(checkpoint_dir(spark), f"run-{uuid.uuid4().hex}")
    return d


def _stream_ingest(spark, sf):
    from strata.streaming.ingest import VersionedTable, stream_upsert
    base = _scratch(spark)
    landing = os.path.join(base, "landing")
    landed = _landed(spark, sf)
    landed.write.partitionBy("Processing_Date").parquet(landing)
    target = VersionedTable(spark, os.path.join(base, "bronze"))
    stream_upsert(spark, landing, landed.schema, target, "o_orderkey", os.path.join(base, "_checkpoint"),
                  files_per_batch=4)
    return target.current().select(*ORDER_COLS, "Processing_Date")


Q["stream_ingest"] = _stream_ingest
SQL["stream_ingest"] = f"WITH {LANDED_SQL} SELECT * FROM landed"


# --- B09: layered run -------------------------------------------------------------------------
def _increments(landed):
    """The bulk load, then every landed increment in order (one row per date)."""
    return [str(r[0]) for r in landed.select("Processing_Date").distinct().orderBy("Processing_Date").collect()]


def _medallion(spark, sf):
    from strata.catalog.history_queries import _cust_v
    from strata.plans.medallion import Layers, run_layers
    from strata.sources.landing import publish
    base = _scratch(spark)
    landed = _landed(spark, sf).select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"), F.col("o_totalprice").alias("total_amount_cad"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("channel"), "Processing_Date")
    versions = publish(_cust_v(spark, sf), "customer_versions", base)
    rules = {"null_amount": "total_amount_cad IS NULL"}
    st = Layers()
    for cut in _increments(landed):
        st = run_layers(spark, st, landed.where(F.col("Processing_Date") <= F.lit(cut).cast("date")),
                        ["transaction_id"], versions, "customer_id", "transaction_date", rules, base, "txn")
    return st.gold


Q["medallion_daily"] = _medallion
SQL["medallion_daily"] = oracle("""
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS transaction_date,
       o_totalprice AS total_amount_cad, o_orderpriority AS channel,
       CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN DATE '2000-12-31'
            ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS Processing_Date,
       v.effective_from AS customer_version_from
FROM orders LEFT JOIN cust_versions v ON o_custkey = v.customer_id AND CAST(o_orderdate AS DATE) >= v.effective_from
  AND CAST(o_orderdate AS DATE) < v.effective_to""", FIX_CTES)


def _medallion_partitioned(spark, sf):
    """B09 at scale: layers as tables partitioned by order month, each
    increment rewriting only the months it touches."""
    from strata.catalog.history_queries import _cust_v
    from strata.plans.medallion import run_layers_partitioned
    from strata.sources.landing import publish, read_partitioned
    base = _scratch(spark)
    landed = _landed(spark, sf).select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"), F.col("o_totalprice").alias("total_amount_cad"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("channel"), "Processing_Date",
        F.trunc(F.col("o_orderdate").cast("date"), "month").cast("date").alias("order_month"))
    versions = publish(_cust_v(spark, sf), "customer_versions", base)
    rules = {"null_amount": "total_amount_cad IS NULL"}
    wm = "1900-01-01"
    for cut in _increments(landed):
        wm = run_layers_partitioned(spark, base, wm, landed.where(F.col("Processing_Date") <= F.lit(cut).cast("date")),
                                    ["transaction_id"], "order_month", versions, "customer_id", "transaction_date",
                                    rules, "txn", keys_stay=True)  # an order keeps its date
    return read_partitioned(spark, os.path.join(base, "gold_txn"))


Q["medallion_partitioned"] = _medallion_partitioned
SQL["medallion_partitioned"] = oracle("""
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS transaction_date,
       o_totalprice AS total_amount_cad, o_orderpriority AS channel,
       CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN DATE '2000-12-31'
            ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS Processing_Date,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
       v.effective_from AS customer_version_from
FROM orders LEFT JOIN cust_versions v ON o_custkey = v.customer_id AND CAST(o_orderdate AS DATE) >= v.effective_from
  AND CAST(o_orderdate AS DATE) < v.effective_to""", FIX_CTES)


# --- B02, B05, B09: registry-driven run ----------------------------------------------------
# Fixed values of the fixture: bulk boundary, the two days, the day of the attribute changes.
RUN_DAYS = ("2001-01-31", "2001-02-28")
RUN_TABLES = ("dim_banner", "dim_store", "dim_product", "fact_sales_transaction", "fact_inventory_snapshot")
RUN_KEYS = {"fact_sales_transaction": ["transaction_id"], "fact_inventory_snapshot": ["snapshot_date", "store_id", "product_id"]}
_RUNS: dict = {}


def _registry_run(spark, sf):
    """The bulk load and two days over three dimensions and two facts. One
    dimension has no readable source: its failure is audited and stays alone."""
    from strata.plans.registry_run import Plan, run_registry
    key = (spark.sparkContext.applicationId, sf)
    if key in _RUNS:
        return _RUNS[key]
    star = _star(spark, sf)
    dates = {"fact_sales_transaction": "transaction_date", "fact_inventory_snapshot": "snapshot_date"}

    def source(name, day):
        if name == "dim_changes":
            return None if day != RUN_DAYS[0] else FX.product_changes(read_table(spark, sf, "part")).drop("Processing_Date")
        if name == "dim_store":
            raise FileNotFoundError("no source of dim_store")
        df = star.table(name)
        if name == "fact_inventory_snapshot":  # some rows without a quantity
            df = df.withColumn("quantity", F.when(F.col("is_out_of_stock") == 0, F.col("on_hand_units")))
        if name in dates:
            d = F.col(dates[name])
            df = df.where(d < F.lit("2001-01-01").cast("date") if day is None else d == F.lit(day).cast("date"))
            df = df.withColumn("year", F.date_format(d, "yyyy"))
        return df

    reg = C.registry(spark).where(F.col("table_name").isin(*RUN_TABLES))
    own = F.create_map(*[x for k, v in RUN_KEYS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    reg = reg.withColumn("business_keys", F.coalesce(F.try_element_at(own, "table_name"), "business_keys"))
    reg = reg.withColumn("track_attrs", F.when(F.col("table_name") == "dim_product", F.array(
        F.lit("product_name"), F.lit("list_price_cad"), F.lit("cost_price_cad"))).otherwise(F.col("track_attrs")))
    plan = Plan(_scratch(spark), source, rules={"dim_product": DQ.RULES["dim_product"],
                                                      "fact_inventory_snapshot": DQ.RULES["fact_sales_line_item"]},
                partitions=dict.fromkeys(RUN_KEYS, "year"),
                versions={"fact_inventory_snapshot": [("product", "dim_product", "product_id", "snapshot_date")]}, buckets=2)
    run = run_registry(spark, plan, reg, "bulk", "2000-12-31")
    for day in RUN_DAYS:
        run.run("daily", day)
    _RUNS[key] = run
    return run


Q["run_audit"] = lambda spark, sf: _registry_run(spark, sf).audit_table().drop("run_ts")
Q["run_watermarks"] = lambda spark, sf: _registry_run(spark, sf).watermarks().select(
    "table_name", F.col("last_processing_date").cast("string").alias("last_processing_date"), "last_rows_affected")


def _run_gold(spark, sf):
    """The stock fact's surrogate keys joined back to the gold dimension."""
    run = _registry_run(spark, sf)
    v = run.read("gold", "dim_product").select("product_sk", F.col("effective_from").alias("product_version_from"))
    return run.read("gold", "fact_inventory_snapshot").join(v, "product_sk", "left").select(
        "snapshot_date", "store_id", "product_id", "product_version_from")


Q["run_gold_inventory"] = _run_gold
_RUN_DAYS_SQL = ", ".join(f"DATE '{d}'" for d in RUN_DAYS)
_CHG = ("(o.product_name IS DISTINCT FROM p.product_name OR o.list_price_cad IS DISTINCT FROM p.list_price_cad "
        "OR o.cost_price_cad IS DISTINCT FROM p.cost_price_cad)")
_RUN_CTES = FIX_CTES + f""",
stock AS (SELECT *, CASE WHEN is_out_of_stock = 0 THEN on_hand_units END AS q,
  CASE WHEN snapshot_date < DATE '2001-01-01' THEN DATE '2000-12-31' ELSE snapshot_date END AS pd
  FROM fact_inventory_snapshot WHERE snapshot_date < DATE '2001-01-01' OR snapshot_date IN ({_RUN_DAYS_SQL})),
txns AS (SELECT *, CASE WHEN transaction_date < DATE '2001-01-01' THEN DATE '2000-12-31' ELSE transaction_date END AS pd
  FROM fact_sales_transaction WHERE transaction_date < DATE '2001-01-01' OR transaction_date IN ({_RUN_DAYS_SQL})),
prod AS (SELECT p.product_id, p.cost_price_cad <= p.list_price_cad AS was_ok, o.cost_price_cad <= o.list_price_cad AS now_ok,
  {_CHG} AS changed FROM dim_product p JOIN overlay o ON p.sku = o.sku),
pn AS (SELECT count(*) AS n, count(*) FILTER (was_ok) AS ok, count(*) FILTER (NOT now_ok) AS bad2,
  count(*) FILTER (now_ok AND (changed OR NOT was_ok)) AS ins2, count(*) FILTER (now_ok AND changed AND was_ok) AS shut2
  FROM prod),
tc AS (SELECT pd, count(*) AS n FROM txns GROUP BY pd),
lc AS (SELECT pd, count(*) AS n, count(*) FILTER (q <> 0) AS ok, count(*) FILTER (q IS NULL OR q = 0) AS bad FROM stock GROUP BY pd),
days AS (SELECT unnest([DATE '2000-12-31', {_RUN_DAYS_SQL}]) AS pd)"""


def _ins(n, upd="0"):
    return f"'ins=' || ({n}) || ' upd=' || ({upd})"


SQL["run_audit"] = oracle(f"""
SELECT 'land' AS notebook, 'landing' AS layer, t AS table_name, n AS rows_affected, 'OK' AS status,
       'pd=' || CAST(pd AS VARCHAR) AS message
FROM (SELECT 'fact_sales_transaction' AS t, days.pd, coalesce(n, 0) AS n FROM days LEFT JOIN tc USING (pd)
      UNION ALL SELECT 'fact_inventory_snapshot', days.pd, coalesce(n, 0) FROM days LEFT JOIN lc USING (pd)
      UNION ALL SELECT 'dim_banner', DATE '2000-12-31', count(*) FROM dim_banner
      UNION ALL SELECT 'dim_product', DATE '2000-12-31', n FROM pn
      UNION ALL SELECT 'dim_changes', DATE '{RUN_DAYS[0]}', count(*) FROM pchg)
UNION ALL SELECT 'landing 2000-12-31', 'landing', 'dim_store', 0, 'FAILED', 'FileNotFoundError: no source of dim_store'
UNION ALL SELECT layer, layer, 'dim_banner', n, 'OK', {_ins('n')}
  FROM (SELECT count(*) AS n FROM dim_banner), (SELECT unnest(['bronze', 'silver', 'gold']) AS layer)
UNION ALL SELECT layer, layer, 'fact_sales_transaction', n, 'OK', {_ins('n')}
  FROM tc, (SELECT unnest(['bronze', 'silver', 'gold']) AS layer)
UNION ALL SELECT 'bronze', 'bronze', 'fact_inventory_snapshot', n, 'OK', {_ins('n')} FROM lc
UNION ALL SELECT layer, layer, 'fact_inventory_snapshot', ok, 'OK', {_ins('ok')}
  FROM lc, (SELECT unnest(['silver', 'gold']) AS layer)
UNION ALL SELECT 'quality', 'quarantine', 'fact_inventory_snapshot', bad, 'QUARANTINE', 'zero_quantity' FROM lc WHERE bad > 0
UNION ALL SELECT 'bronze', 'bronze', 'dim_product', n, 'OK', {_ins('n')} FROM pn
UNION ALL SELECT 'quality', 'quarantine', 'dim_product', n - ok, 'QUARANTINE', 'cost_gt_list' FROM pn WHERE n > ok
UNION ALL SELECT 'silver', 'silver', 'dim_product', ok, 'OK', 'scd2 ins=' || ok || ' closed=0' FROM pn
UNION ALL SELECT 'gold', 'gold', 'dim_product', ok, 'OK', {_ins('ok')} FROM pn
UNION ALL SELECT 'quality', 'quarantine', 'dim_product', bad2, 'QUARANTINE', 'cost_gt_list' FROM pn WHERE bad2 > 0
UNION ALL SELECT 'silver', 'silver', 'dim_product', ins2 + shut2, 'OK', 'scd2 ins=' || ins2 || ' closed=' || shut2 FROM pn
UNION ALL SELECT 'gold', 'gold', 'dim_product', ins2 + shut2, 'OK', {_ins('ins2', 'shut2')} FROM pn""", _RUN_CTES)

SQL["run_watermarks"] = oracle(f"""
SELECT 'dim_banner' AS table_name, '2000-12-31' AS last_processing_date, count(*) AS last_rows_affected FROM dim_banner
UNION ALL SELECT 'dim_product', '{RUN_DAYS[0]}', CAST(0 AS BIGINT)
UNION ALL SELECT 'fact_sales_transaction', CAST(max(pd) AS VARCHAR), arg_max(n, pd) FROM tc
UNION ALL SELECT 'fact_inventory_snapshot', CAST(max(pd) AS VARCHAR), arg_max(n, pd) FROM lc""", _RUN_CTES)

SQL["run_gold_inventory"] = oracle(f"""
SELECT l.snapshot_date, l.store_id, l.product_id,
       CASE WHEN l.snapshot_date >= DATE '{RUN_DAYS[0]}' AND now_ok AND (changed OR NOT was_ok)
            THEN DATE '{RUN_DAYS[0]}' WHEN was_ok THEN DATE '1900-01-01' END AS product_version_from
FROM stock l LEFT JOIN prod p ON l.product_id = p.product_id WHERE l.q <> 0""", _RUN_CTES)

# --- A08 / C06: two consumers at different positions ------------------------------------------


def _changes_since(spark, sf):
    """Three versions of the orders: loaded, upserted, some deleted. One consumer
    has taken over the first version, one the second, one nothing yet."""
    from strata.catalog.history_queries import _merged, _newv
    from strata.sources.changes import ChangeReader, commit_changes
    base, o = _scratch(spark), _orders(spark, sf)
    first, second = FX.upsert_target(o), L.publish(_merged(spark, sf), "orders_v1", spark=spark)
    third, reader = _newv(second), ChangeReader(spark, "orders", f"{base}/orders_changes", f"{base}/control")
    for version, (old, new) in enumerate(((None, first), (first, second), (second, third))):
        commit_changes(MG.change_feed(old, new, "o_orderkey"), reader.path, version, F.lit(f"2001-02-0{version + 1}"))
    reader.advance("after_load", 0)
    reader.advance("after_upsert", 1)
    out = None
    for consumer in ("after_load", "after_upsert", "newcomer"):
        got, _ = reader.read(consumer, third)
        got = got.select(F.lit(consumer).alias("consumer"), *ORDER_COLS, "_change_type", "_commit_version")
        out = got if out is None else out.unionByName(got)
    return out


Q["changes_since"] = _changes_since
_ODIFF = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in ORDER_COLS[1:])
SQL["changes_since"] = oracle(f"""
SELECT 'after_load' AS consumer, n.*, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM merged n
WHERE NOT EXISTS (SELECT 1 FROM tgt o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL SELECT 'after_load', n.*, 'update_postimage', 1 FROM tgt o JOIN merged n ON o.o_orderkey = n.o_orderkey
WHERE {_ODIFF}
UNION ALL SELECT c, m.*, 'delete', 2 FROM merged m, (SELECT unnest(['after_load', 'after_upsert']) AS c)
WHERE NOT EXISTS (SELECT 1 FROM newv n WHERE n.o_orderkey = m.o_orderkey)
UNION ALL SELECT 'newcomer', n.*, 'insert', 2 FROM newv n""", FIX_CTES)
