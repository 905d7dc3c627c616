"""Time intelligence (T01-T08, M34-M39, M41) and analysis
queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.catalog.prelude import oracle
from strata.catalog.sqlfrag import cents, divide, money, money_avg, money_mean, msum, ratio, round6
from strata.plans import analysis as A
from strata.plans import context as X
from strata.plans import metrics as M
from strata.plans import timecalc as T
from strata.plans.star import Where
from strata.sources.fixtures import retail_star

Q: dict = {}
SQL: dict = {}

N_NET = msum("l.line_subtotal_cad")
N_COST = msum("l.line_cost_cad")
MONTH = "CAST(date_trunc('month', {d}) AS DATE)"
LINE_STORE = "fact_sales_line_item l LEFT JOIN dim_store s ON l.store_id = s.store_id"
LINE_PROD = "fact_sales_line_item l LEFT JOIN dim_product p ON l.product_id = p.product_id"
TXN_STORE = "fact_sales_transaction t LEFT JOIN dim_store s ON t.store_id = s.store_id"


def star(spark, sf):
    return retail_star(spark, sf)


def _yoy(c, p):
    return round6(f"CASE WHEN {c} IS NOT NULL OR {p} IS NOT NULL THEN coalesce({c}, 0) - coalesce({p}, 0) END")


def _yoy_pct(c, p):
    return round6(divide(f"coalesce({c}, 0) - {p}", p))


def _points(c, p):
    return f"CASE WHEN {p} IS NOT NULL THEN {round6(f'(coalesce({c}, 0) - {p}) * 100')} END"


def _cells(table, grain, *by):
    """(keys, FROM) of current cells c and prior-year cells p of ``table``; a
    cell with a prior year only counts up to the end of the calendar."""
    later = "p.year + 1" if grain == "year" else "CAST(p.month + INTERVAL 12 MONTH AS DATE)"
    last = "year(last_day)" if grain == "year" else "last_day"
    on = " AND ".join([*(f"c.{k} IS NOT DISTINCT FROM p.{k}" for k in by), f"c.{grain} = {later}"])
    keys = ", ".join([*(f"CASE WHEN c.{grain} IS NULL THEN p.{k} ELSE c.{k} END AS {k}" for k in by),
                      f"coalesce(c.{grain}, {later}) AS {grain}"])
    return keys, (f"FROM {table} c FULL JOIN {table} p ON {on} "
                  f"WHERE c.{grain} IS NOT NULL OR {later} <= (SELECT {last} FROM cal_ends)")


_BANNER_NAME_YEAR_B = _cells("b", "year", "banner_name")
_CATEGORY_NAME_YEAR_B = _cells("b", "year", "category_name")
_CHANNEL_MONTH_B = _cells("b", "month", "channel")
_CHANNEL_YEAR_Y = _cells("y", "year", "channel")
_YEAR_Y = _cells("y", "year")


# --- T02: PY of a ratio metric -------------------------------------------------------
def _time_py(spark, sf):
    return T.with_prior_year(star(spark, sf), ["gross_margin_pct"], ["banner_name"], "year")


Q["time_py"] = _time_py
SQL["time_py"] = oracle(f"""
SELECT {_BANNER_NAME_YEAR_B[0]}, {ratio('c.sn - c.sc', 'c.sn')} AS gross_margin_pct,
       {ratio('p.sn - p.sc', 'p.sn')} AS gross_margin_pct_py
{_BANNER_NAME_YEAR_B[1]}""", f"""
b AS (SELECT s.banner_name, year(l.transaction_date) AS year, {N_NET} AS sn, {N_COST} AS sc
      FROM {LINE_STORE} GROUP BY 1, 2)""")


# --- T03: YoY absolute -----------------------------------------------------------------
def _time_yoy(spark, sf):
    return T.with_prior_year(star(spark, sf), ["net_sales"], ["category_name"], "year",
                             changes={"net_sales_yoy": ("net_sales", T.yoy)})


Q["time_yoy"] = _time_yoy
SQL["time_yoy"] = oracle(f"""
SELECT {_CATEGORY_NAME_YEAR_B[0]}, {cents('c.sn')} AS net_sales, {cents('p.sn')} AS net_sales_py,
       {_yoy(money('c.sn'), money('p.sn'))} AS net_sales_yoy
{_CATEGORY_NAME_YEAR_B[1]}""", f"""
b AS (SELECT p.category_name, year(l.transaction_date) AS year, {N_NET} AS sn FROM {LINE_PROD} GROUP BY 1, 2)""")


# --- T04: YoY % of a distinct count, month grain ---------------------------------------
def _time_yoy_pct(spark, sf):
    return T.with_prior_year(star(spark, sf), ["transactions"], ["channel"], "month",
                             changes={"transactions_yoy_pct": ("transactions", T.yoy_pct)})


Q["time_yoy_pct"] = _time_yoy_pct
SQL["time_yoy_pct"] = oracle(f"""
SELECT {_CHANNEL_MONTH_B[0]}, c.n AS transactions, p.n AS transactions_py, {_yoy_pct('c.n', 'p.n')} AS transactions_yoy_pct
{_CHANNEL_MONTH_B[1]}""", f"""
b AS (SELECT channel, {MONTH.format(d='transaction_date')} AS month, count(DISTINCT transaction_id) AS n
      FROM fact_sales_transaction GROUP BY 1, 2)""")


# --- T05: YTD of additive, distinct and ratio metrics -------------------------------------
def _time_ytd(spark, sf):
    return T.to_date(star(spark, sf), ["net_sales", "transactions", "gross_margin_pct", "active_customers"],
                     [], "year", "month")


Q["time_ytd"] = _time_ytd
SQL["time_ytd"] = oracle(f"""
SELECT g.month, {cents('(SELECT sum(sn) FROM ln WHERE year(ln.month) = year(g.month) AND ln.month <= g.month)')}
         AS net_sales,
       (SELECT count(DISTINCT transaction_id) FROM fact_sales_transaction t
         WHERE year(t.transaction_date) = year(g.month) AND {MONTH.format(d='t.transaction_date')} <= g.month)
         AS transactions,
       {ratio('(SELECT sum(sn) - sum(sc) FROM ln WHERE year(ln.month) = year(g.month) AND ln.month <= g.month)',
              '(SELECT sum(sn) FROM ln WHERE year(ln.month) = year(g.month) AND ln.month <= g.month)')}
         AS gross_margin_pct,
       (SELECT count(DISTINCT customer_id) FROM fact_sales_transaction t
         WHERE year(t.transaction_date) = year(g.month) AND {MONTH.format(d='t.transaction_date')} <= g.month)
         AS active_customers
FROM (SELECT DISTINCT month FROM cal) g WHERE EXISTS (SELECT 1 FROM grid WHERE year(grid.month) = year(g.month) AND grid.month <= g.month)""", f"""
ln AS (SELECT {MONTH.format(d='l.transaction_date')} AS month, {N_NET} AS sn, {N_COST} AS sc
       FROM fact_sales_line_item l GROUP BY 1),
grid AS (SELECT month FROM ln UNION SELECT {MONTH.format(d='transaction_date')} FROM fact_sales_transaction)""")


# --- T06: MTD at day grain ----------------------------------------------------------------
def _time_mtd(spark, sf):
    return T.to_date(star(spark, sf), ["net_sales", "distinct_skus"], [], "month", "date")


Q["time_mtd"] = _time_mtd
_MTD_SN = ("(SELECT sum(sn) FROM dn WHERE date_trunc('month', dn.date) = date_trunc('month', g.date) "
           "AND dn.date <= g.date)")
SQL["time_mtd"] = oracle(f"""
SELECT g.date, {cents(_MTD_SN)} AS net_sales,
       (SELECT count(DISTINCT product_id) FROM fact_sales_line_item l
         WHERE date_trunc('month', l.transaction_date) = date_trunc('month', g.date) AND l.transaction_date <= g.date)
         AS distinct_skus
FROM cal g WHERE EXISTS (SELECT 1 FROM dn WHERE date_trunc('month', dn.date) = date_trunc('month', g.date) AND dn.date <= g.date)""", f"""
dn AS (SELECT l.transaction_date AS date, {N_NET} AS sn FROM fact_sales_line_item l GROUP BY 1)""")


# --- T07: QTD by channel ----------------------------------------------------------------
def _time_qtd(spark, sf):
    return T.to_date(star(spark, sf), ["revenue_incl_tax", "active_customers"], ["channel"], "quarter", "month")


Q["time_qtd"] = _time_qtd
_QK = "year({m}) * 10 + quarter({m})"
SQL["time_qtd"] = oracle(f"""
SELECT g.channel, g.month,
  {cents("(SELECT sum(sr) FROM tm WHERE tm.channel = g.channel AND " + _QK.format(m='tm.month') + " = " + _QK.format(m='g.month') + " AND tm.month <= g.month)")}
    AS revenue_incl_tax,
  (SELECT count(DISTINCT customer_id) FROM fact_sales_transaction t WHERE t.channel = g.channel
     AND {_QK.format(m='t.transaction_date')} = {_QK.format(m='g.month')}
     AND {MONTH.format(d='t.transaction_date')} <= g.month) AS active_customers
FROM (SELECT DISTINCT ch.channel, cal.month FROM (SELECT DISTINCT channel, year(month) AS y, quarter(month) AS q,
        min(month) OVER (PARTITION BY channel, year(month), quarter(month)) AS first FROM tm) ch
      JOIN cal ON year(cal.month) = ch.y AND quarter(cal.month) = ch.q AND cal.month >= ch.first) g""", f"""
tm AS (SELECT channel, {MONTH.format(d='transaction_date')} AS month, {msum('total_amount_cad')} AS sr
       FROM fact_sales_transaction GROUP BY 1, 2)""")


# --- T01/T08: all calculation items as rows -----------------------------------------------
def _time_calc(spark, sf):
    return T.time_items(star(spark, sf), "net_sales", [])


Q["time_calc"] = _time_calc
_CUR, _PY = cents("c.sn"), cents("p.sn")
SQL["time_calc"] = oracle(f"""
SELECT month, time_calc, ordinal, value FROM (
  SELECT g.month, CAST({_CUR} AS DOUBLE) AS v0, CAST({_PY} AS DOUBLE) AS v1, {_yoy(money('c.sn'), money('p.sn'))} AS v2,
         {_yoy_pct(money('c.sn'), money('p.sn'))} AS v3,
         CAST({cents('sum(c.sn) OVER (PARTITION BY year(g.month) ORDER BY g.month ROWS UNBOUNDED PRECEDING)')} AS DOUBLE) AS v4,
         CAST({_CUR} AS DOUBLE) AS v5,
         CAST({cents('sum(c.sn) OVER (PARTITION BY year(g.month), quarter(g.month) ORDER BY g.month ROWS UNBOUNDED PRECEDING)')} AS DOUBLE) AS v6
  FROM (SELECT DISTINCT month FROM cal) g LEFT JOIN m c ON c.month = g.month
       LEFT JOIN m p ON g.month = p.month + INTERVAL 12 MONTH)
CROSS JOIN LATERAL (VALUES ('Current', 0, v0), ('PY', 1, v1), ('YoY', 2, v2), ('YoY %', 3, v3), ('YTD', 4, v4),
                           ('MTD', 5, v5), ('QTD', 6, v6)) AS x(time_calc, ordinal, value)
WHERE v1 IS NOT NULL OR v4 IS NOT NULL""", f"""
m AS (SELECT {MONTH.format(d='transaction_date')} AS month, {msum('line_subtotal_cad')} AS sn
      FROM fact_sales_line_item GROUP BY 1)""")


# --- M34-M39: YoY measures ---------------------------------------------------------------
def _change(name, metric, by, how):
    def fn(spark, sf):
        return T.with_prior_year(star(spark, sf), [metric], by, "year", changes={name: (metric, how)}).select(
            *by, "year", name)
    return fn


Q["net_sales_yoy"] = _change("net_sales_yoy", "net_sales", [], T.yoy_pct)
SQL["net_sales_yoy"] = oracle(f"""
SELECT {_YEAR_Y[0]}, {_yoy_pct(money('c.sn'), money('p.sn'))} AS net_sales_yoy
{_YEAR_Y[1]}""", f"""
y AS (SELECT year(transaction_date) AS year, {msum('line_subtotal_cad')} AS sn FROM fact_sales_line_item GROUP BY 1)""")

Q["gm_pct_delta"] = _change("gm_pct_delta", "gross_margin_pct", ["banner_name"], T.delta_points)
_GMC, _GMP = divide("(c.sn - c.sc)", "c.sn"), divide("(p.sn - p.sc)", "p.sn")
SQL["gm_pct_delta"] = oracle(f"""
SELECT {_BANNER_NAME_YEAR_B[0]}, {_points(_GMC, _GMP)} AS gm_pct_delta
{_BANNER_NAME_YEAR_B[1]}""", f"""
b AS (SELECT s.banner_name, year(l.transaction_date) AS year, {N_NET} AS sn, {N_COST} AS sc
      FROM {LINE_STORE} GROUP BY 1, 2)""")

Q["transactions_yoy"] = _change("transactions_yoy", "transactions", [], T.yoy_pct)
SQL["transactions_yoy"] = oracle(f"""
SELECT {_YEAR_Y[0]}, {_yoy_pct('c.n', 'p.n')} AS transactions_yoy {_YEAR_Y[1]}""", """
y AS (SELECT year(transaction_date) AS year, count(DISTINCT transaction_id) AS n FROM fact_sales_transaction GROUP BY 1)""")

Q["atv_yoy"] = _change("atv_yoy", "avg_txn_value", ["channel"], T.yoy_pct)
SQL["atv_yoy"] = oracle(f"""
SELECT {_CHANNEL_YEAR_Y[0]}, {_yoy_pct(money_mean('c.sr', 'c.n'), money_mean('p.sr', 'p.n'))} AS atv_yoy
{_CHANNEL_YEAR_Y[1]}""", f"""
y AS (SELECT channel, year(transaction_date) AS year, {msum('total_amount_cad')} AS sr,
             count(DISTINCT transaction_id) AS n FROM fact_sales_transaction GROUP BY 1, 2)""")

Q["loyalty_pen_delta"] = _change("loyalty_pen_delta", "loyalty_txn_pct", [], T.delta_points)
_LC, _LP = divide("c.nl", "c.n"), divide("p.nl", "p.n")
SQL["loyalty_pen_delta"] = oracle(f"""
SELECT {_YEAR_Y[0]}, {_points(_LC, _LP)} AS loyalty_pen_delta
{_YEAR_Y[1]}""", """
y AS (SELECT year(transaction_date) AS year, count(DISTINCT transaction_id) AS n,
             count(DISTINCT CASE WHEN is_loyalty_transaction = 1 THEN transaction_id END) AS nl
      FROM fact_sales_transaction GROUP BY 1)""")

Q["upt_yoy"] = _change("upt_yoy", "units_per_txn", [], T.yoy_pct)
SQL["upt_yoy"] = oracle(f"""
SELECT {_YEAR_Y[0]}, {_yoy_pct(divide('c.u', 'c.n'), divide('p.u', 'p.n'))} AS upt_yoy
{_YEAR_Y[1]}""", """
y AS (SELECT coalesce(a.year, b.year) AS year, a.u, b.n FROM
        (SELECT year(transaction_date) AS year, sum(quantity) AS u FROM fact_sales_line_item GROUP BY 1) a
        FULL JOIN (SELECT year(transaction_date) AS year, count(DISTINCT transaction_id) AS n
                   FROM fact_sales_transaction GROUP BY 1) b ON a.year = b.year)""")


# --- M41 / E14: rolling 3 months -------------------------------------------------------------
def _rolling(spark, sf):
    return T.rolling(star(spark, sf), "net_sales", ["banner_name"], 3)


Q["rolling_3m"] = _rolling
SQL["rolling_3m"] = oracle(f"""
SELECT g.banner_name, g.month, {cents('sum(w.sn)')} AS net_sales
FROM bm g LEFT JOIN bm w ON g.banner_name IS NOT DISTINCT FROM w.banner_name
  AND w.month > g.month - INTERVAL 3 MONTH AND w.month <= g.month
GROUP BY 1, 2""", f"""
bm AS (SELECT s.banner_name, {MONTH.format(d='l.transaction_date')} AS month, {N_NET} AS sn
       FROM {LINE_STORE} GROUP BY 1, 2)""")

# --- M10 / M11: same store --------------------------------------------------------------------
Q["same_store_sales"] = lambda spark, sf: A.same_store(star(spark, sf)).select("year", "same_store_sales")
_SSY = f"""sy AS (SELECT store_id, year(transaction_date) AS year, {msum('line_subtotal_cad')} AS s
       FROM fact_sales_line_item GROUP BY 1, 2)"""
SQL["same_store_sales"] = oracle(f"""
SELECT c.year, {cents('sum(c.s)')} AS same_store_sales FROM sy c
WHERE EXISTS (SELECT 1 FROM sy p WHERE p.store_id = c.store_id AND p.year = c.year - 1) GROUP BY 1""", _SSY)

Q["same_store_growth"] = lambda spark, sf: A.same_store(star(spark, sf))
SQL["same_store_growth"] = oracle(f"""
SELECT c.year, {cents('sum(c.s)')} AS same_store_sales, {cents('sum(p.s)')} AS same_store_sales_py,
       {ratio('sum(c.s) - sum(p.s)', 'sum(p.s)')} AS same_store_growth
FROM sy c JOIN sy p ON p.store_id = c.store_id AND p.year = c.year - 1 GROUP BY 1""", _SSY)

# --- M12 / M42: shares -------------------------------------------------------------------------
Q["net_sales_share"] = lambda spark, sf: A.share_of_total(star(spark, sf), ["banner_name", "year"], ["banner_name"],
                                                          name="net_sales_share")
SQL["net_sales_share"] = oracle(f"""
SELECT banner_name, year, {cents('sn')} AS net_sales, {ratio('sn', 'sum(sn) OVER (PARTITION BY year)')} AS net_sales_share
FROM (SELECT s.banner_name, year(l.transaction_date) AS year, {N_NET} AS sn FROM {LINE_STORE} GROUP BY 1, 2)""")

Q["category_share"] = lambda spark, sf: A.share_of_total(star(spark, sf), ["category_name", "brand"], ["brand"],
                                                         name="category_share")
SQL["category_share"] = oracle(f"""
SELECT category_name, brand, {cents('sn')} AS net_sales,
       {ratio('sn', 'sum(sn) OVER (PARTITION BY category_name)')} AS category_share
FROM (SELECT p.category_name, p.brand, {N_NET} AS sn FROM {LINE_PROD} GROUP BY 1, 2)""")

# --- M40: rank -------------------------------------------------------------------------------
Q["sales_rank"] = lambda spark, sf: A.sales_rank(star(spark, sf), "banner_name")
SQL["sales_rank"] = oracle(f"""
SELECT banner_name, g AS grouping_id, {cents('sn')} AS net_sales,
       CASE WHEN g = 0 THEN dense_rank() OVER (PARTITION BY g ORDER BY sn DESC) END AS sales_rank
FROM (SELECT s.banner_name, CAST(grouping(s.banner_name) AS BIGINT) AS g, {N_NET} AS sn
      FROM {LINE_STORE} GROUP BY ROLLUP (s.banner_name))""")

# --- M43 / M56: top-N -------------------------------------------------------------------------
Q["top_n_sales"] = lambda spark, sf: A.top_n_sales(star(spark, sf), "product_name", ["year"], A.top_n_parameter())
_PY_RANK = f"""pr AS (SELECT year, product_name, sn, rank() OVER (PARTITION BY year ORDER BY sn DESC) AS rk FROM
  (SELECT year(l.transaction_date) AS year, p.product_name, {N_NET} AS sn FROM {LINE_PROD} GROUP BY 1, 2))"""
SQL["top_n_sales"] = oracle(f"""
SELECT year, {cents('sum(sn)')} AS top_n_sales, count(*) AS members FROM pr WHERE rk <= 10 GROUP BY 1""", _PY_RANK)

Q["series_topn"] = lambda spark, sf: A.top_n_curve(star(spark, sf), "product_name", A.TOP_N_SERIES)
SQL["series_topn"] = oracle(f"""
SELECT n.top_n, {cents('sum(r.sn)')} AS top_n_sales, count(*) AS members
FROM (SELECT * FROM range(5, 51, 5) t(top_n)) n JOIN r ON r.rk <= n.top_n GROUP BY 1""", f"""
r AS (SELECT product_name, sn, rank() OVER (ORDER BY sn DESC) AS rk FROM
  (SELECT p.product_name, {N_NET} AS sn FROM {LINE_PROD} GROUP BY 1))""")

# --- M44: Pareto -------------------------------------------------------------------------------
Q["pareto"] = lambda spark, sf: A.pareto(star(spark, sf), "product_name")
SQL["pareto"] = oracle(f"""
SELECT product_name, {cents('sn')} AS net_sales,
       {ratio('sum(sn) OVER (ORDER BY sn DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)',
              'sum(sn) OVER ()')} AS running_share
FROM (SELECT p.product_name, {N_NET} AS sn FROM {LINE_PROD} GROUP BY 1)""")

# --- M45 / M46: cohorts --------------------------------------------------------------------------
Q["cohort_size"] = lambda spark, sf: A.cohort_size(star(spark, sf))
SQL["cohort_size"] = oracle("""
SELECT enrollment_month, count(DISTINCT customer_business_key) AS cohort_size FROM dim_customer GROUP BY 1""")

Q["cohort_retention"] = lambda spark, sf: A.cohort_retention(star(spark, sf), "year")
SQL["cohort_retention"] = oracle(f"""
SELECT a.enrollment_month, a.year, a.n AS active_customers, z.cohort_size, {ratio('a.n', 'z.cohort_size')} AS cohort_retention
FROM (SELECT c.enrollment_month, year(t.transaction_date) AS year, count(DISTINCT t.customer_id) AS n
      FROM fact_sales_transaction t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id GROUP BY 1, 2) a
LEFT JOIN (SELECT enrollment_month, count(DISTINCT customer_business_key) AS cohort_size FROM dim_customer GROUP BY 1) z
  ON a.enrollment_month IS NOT DISTINCT FROM z.enrollment_month""")

# --- M47-M54: margin bridge ----------------------------------------------------------------------
_BR = f"""
pyb AS (SELECT product_id, year(transaction_date) AS year, CAST(sum(quantity) AS DOUBLE) AS q,
               {msum('line_subtotal_cad')} AS net, {msum('line_cost_cad')} AS cost,
               {msum('quantity * unit_list_price_cad')} AS lst, {msum('quantity * unit_discount_cad')} AS dsc
        FROM fact_sales_line_item GROUP BY 1, 2),
t AS (SELECT coalesce(c.year, p.year + 1) AS year, coalesce(p.q, 0.0::DOUBLE) AS q1, coalesce(c.q, 0.0::DOUBLE) AS q2,
             coalesce({divide('p.net - p.cost', 'p.q')}, 0.0::DOUBLE) AS m1u,
             p.net - p.cost AS gm1, c.net - c.cost AS gm2,
             coalesce(c.q, 0.0::DOUBLE) * (coalesce({divide('c.lst', 'c.q')}, 0.0::DOUBLE) - coalesce({divide('p.lst', 'p.q')}, 0.0::DOUBLE)) AS price,
             coalesce(c.q, 0.0::DOUBLE) * (coalesce({divide('c.dsc', 'c.q')}, 0.0::DOUBLE) - coalesce({divide('p.dsc', 'p.q')}, 0.0::DOUBLE)) AS markdown,
             coalesce(c.q, 0.0::DOUBLE) * (coalesce({divide('c.cost', 'c.q')}, 0.0::DOUBLE) - coalesce({divide('p.cost', 'p.q')}, 0.0::DOUBLE)) AS costfx
      FROM pyb c FULL JOIN pyb p ON c.product_id = p.product_id AND c.year = p.year + 1
      WHERE coalesce(c.year, p.year + 1) IN (SELECT DISTINCT year FROM pyb)),
agg AS (SELECT year, sum(q1) AS Q1, sum(q2) AS Q2, sum(gm1) AS GM1, sum(gm2) AS GM2, sum(q2 * m1u) AS A,
               sum(q1 * m1u) AS B, sum(price) AS P, sum(markdown) AS MD, sum(costfx) AS C,
               count(gm1) AS n_py FROM t GROUP BY 1),
br AS (SELECT year, GM2 / 10000.0::DOUBLE AS gm,
              CASE WHEN n_py > 0 THEN GM1 / 10000.0::DOUBLE END AS gm_py,
              CASE WHEN n_py > 0 THEN {divide('Q2 - Q1', 'Q1')} * (GM1 / 10000.0::DOUBLE) END AS volume,
              CASE WHEN Q1 > 0 THEN (A - B * {divide('Q2', 'Q1')}) / 10000.0::DOUBLE END AS mix,
              CASE WHEN n_py > 0 THEN P / 10000.0::DOUBLE END AS price,
              CASE WHEN n_py > 0 THEN -MD / 10000.0::DOUBLE END AS markdown,
              CASE WHEN n_py > 0 THEN -C / 10000.0::DOUBLE END AS cost FROM agg)"""


def _c2(x):
    return f"(round(({x}) * 100.0::DOUBLE) / 100.0::DOUBLE + 0.0::DOUBLE)"


Q["gm_bridge"] = lambda spark, sf: A.gm_bridge_rounded(star(spark, sf))
SQL["gm_bridge"] = oracle(f"""
SELECT year, {", ".join(f"{_c2(c)} AS {c}" for c in ("gm", "gm_py", "volume", "mix", "price", "markdown", "cost"))}
FROM br""", _BR)

Q["gm_bridge_steps"] = lambda spark, sf: A.gm_bridge_steps(star(spark, sf))
SQL["gm_bridge_steps"] = oracle(f"""
SELECT year, step, step_order, {_c2('v')} AS value FROM br
CROSS JOIN LATERAL (VALUES ('GM PY', 0, gm_py), ('Volume', 1, volume), ('Mix', 2, mix), ('Price', 3, price),
                           ('Markdown', 4, markdown), ('Cost', 5, cost)) AS x(step, step_order, v)""", _BR)

Q["gm_bridge_check"] = lambda spark, sf: A.gm_bridge_check(star(spark, sf))
_RES = "gm - gm_py - volume - mix - price - markdown - cost"
SQL["gm_bridge_check"] = oracle(f"""
SELECT year, {_c2(_RES)} AS residual, abs({_RES}) < 0.005 AS balanced FROM br""", _BR)

# --- M57: segment labels -----------------------------------------------------------------------
# Which banner categories of the test data play the liquor side.
LIQUOR_CATEGORIES = ["EUROPE", "AMERICA"]


def _segments(spark, sf):
    b = star(spark, sf).table("dim_banner")
    return A.segment_label(b, "banner_category", LIQUOR_CATEGORIES, "banner_segment").select(
        "banner_id", "banner_name", "banner_category", "banner_segment")


Q["segment_label"] = _segments
SQL["segment_label"] = oracle("""
SELECT banner_id, banner_name, banner_category,
       CASE WHEN banner_category IN ('EUROPE', 'AMERICA') THEN 'Liquor' ELSE 'Cannabis' END AS banner_segment
FROM dim_banner""")


# --- A11: the literal step table, with how many years each step has a value ------------
def _bridge_steps(spark, sf):
    steps = spark.createDataFrame(A.BRIDGE_STEPS, "step string, step_order int")
    vals = A.gm_bridge_steps(star(spark, sf)).groupBy("step").agg(F.count("value").alias("years_with_value"))
    return steps.join(vals, "step", "left").select("step", "step_order", "years_with_value")


Q["bridge_steps"] = _bridge_steps
SQL["bridge_steps"] = oracle("""
SELECT s.step, s.step_order, count(v.v) AS years_with_value
FROM (VALUES ('GM PY', 0), ('Volume', 1), ('Mix', 2), ('Price', 3), ('Markdown', 4), ('Cost', 5)) s(step, step_order)
LEFT JOIN (SELECT step, v FROM br CROSS JOIN LATERAL (VALUES ('GM PY', gm_py), ('Volume', volume), ('Mix', mix),
           ('Price', price), ('Markdown', markdown), ('Cost', cost)) AS x(step, v)) v USING (step)
GROUP BY 1, 2""", _BR)


# --- T02 at day grain: every day maps back to one day a year earlier (leap days) ----------
def _time_py_day(spark, sf):
    return T.with_prior_year(star(spark, sf), ["net_sales"], [], "date")


Q["time_py_day"] = _time_py_day
SQL["time_py_day"] = oracle(f"""
SELECT g.date, {cents('c.sn')} AS net_sales, {cents('p.sn')} AS net_sales_py
FROM cal g LEFT JOIN dn c ON c.date = g.date LEFT JOIN dn p ON p.date = CAST(g.date - INTERVAL 12 MONTH AS DATE)
WHERE c.date IS NOT NULL OR p.date IS NOT NULL""", f"""
dn AS (SELECT transaction_date AS date, {msum('line_subtotal_cad')} AS sn FROM fact_sales_line_item GROUP BY 1)""")


# --- F01 / F07: filters on what is not grouped; a date filter does not reach the prior year ----------
def _time_py_filtered(spark, sf):
    asia = Where(("province_code",), F.col("province_code") == "ASIA")
    return T.with_prior_year(star(spark, sf), ["net_sales"], ["brand"], "year", asia, F.col("year") == 1998)


Q["time_py_filtered"] = _time_py_filtered
_BRAND_YEAR_B = _cells("b", "year", "brand")
SQL["time_py_filtered"] = oracle(f"""
SELECT * FROM (SELECT {_BRAND_YEAR_B[0]}, {cents('c.sn')} AS net_sales, {cents('p.sn')} AS net_sales_py
  {_BRAND_YEAR_B[1]}) WHERE year = 1998""", f"""
b AS (SELECT p.brand, year(l.transaction_date) AS year, {N_NET} AS sn
      FROM {LINE_PROD} LEFT JOIN dim_store s ON l.store_id = s.store_id
      WHERE s.province_code = 'ASIA' GROUP BY 1, 2)""")


def _time_ytd_filtered(spark, sf):
    weekend = Where(("is_weekend",), F.col("is_weekend") == 1)
    return T.to_date(star(spark, sf), ["revenue_incl_tax"], ["channel"], "year", "month", weekend,
                     F.month("month") == 6)


Q["time_ytd_filtered"] = _time_ytd_filtered
SQL["time_ytd_filtered"] = oracle(f"""
SELECT t.channel, g.month, {cents(msum('t.total_amount_cad'))} AS revenue_incl_tax
FROM (SELECT DISTINCT month FROM cal WHERE month(month) = 6) g
JOIN fact_sales_transaction t ON year(t.transaction_date) = year(g.month) AND month(t.transaction_date) <= 6
WHERE isodow(t.transaction_date) >= 6 GROUP BY 1, 2""")


# --- M31 in context, rolling distinct counts, same-store and bridge by banner ------------------
_STOCK = f"""stock AS (SELECT s.banner_name, year(i.snapshot_date) AS year, i.snapshot_date AS d,
       {MONTH.format(d='i.snapshot_date')} AS month, {msum('i.inventory_value_cad')} AS v
FROM fact_inventory_snapshot i LEFT JOIN dim_store s ON i.store_id = s.store_id GROUP BY 1, 2, 3, 4)"""

Q["inventory_value_rollup"] = lambda spark, sf: X.stock_rollup(star(spark, sf), ["banner_name", "year"])
SQL["inventory_value_rollup"] = oracle(f"""
SELECT banner_name, year, CAST(0 AS BIGINT) AS grouping_id, {cents('arg_max(v, d)')} AS inventory_value FROM stock GROUP BY 1, 2
UNION ALL SELECT banner_name, NULL, 1, {cents('arg_max(v, d)')}
FROM (SELECT banner_name, d, sum(v) AS v FROM stock GROUP BY 1, 2) GROUP BY 1
UNION ALL SELECT NULL, NULL, 3, {cents('arg_max(v, d)')} FROM (SELECT d, sum(v) AS v FROM stock GROUP BY 1)""", _STOCK)

# --- M16, M20-M22 beside the calendar: no period reaches the customer dimension ------------------
_MEMBERS = ["active_customers", "loyalty_members", "avg_lifetime_spend", "cross_shop_pct", "cross_shop_multiple"]
Q["loyalty_members_by_year"] = lambda spark, sf: X.over_months(star(spark, sf), _MEMBERS, ["loyalty_tier"], "year")
Q["loyalty_members_by_month"] = lambda spark, sf: X.over_months(
    star(spark, sf), ["loyalty_txns", "loyalty_members"], ["segment"], "month",
    Where(("loyalty_tier",), F.col("loyalty_tier") != "Bronze"))


def _avg_spend(flag):
    part = "lifetime_spend_cad" if flag is None else f"CASE WHEN {flag} THEN lifetime_spend_cad END"
    return msum(part), f"count({part})"


_ALL, _ONE, _NONE = _avg_spend(None), _avg_spend("is_cross_category = 1"), _avg_spend("coalesce(is_cross_category, 0) = 0")
SQL["loyalty_members_by_year"] = oracle(f"""
SELECT coalesce(g.loyalty_tier, a.loyalty_tier) AS loyalty_tier, coalesce(g.year, a.year) AS year, a.active_customers,
       g.loyalty_members, g.avg_lifetime_spend, g.cross_shop_pct, g.cross_shop_multiple
FROM (SELECT * FROM members CROSS JOIN (SELECT DISTINCT year(date) AS year FROM cal)) g
FULL JOIN active a ON g.loyalty_tier IS NOT DISTINCT FROM a.loyalty_tier AND g.year = a.year""", f"""
members AS (SELECT loyalty_tier, count(DISTINCT customer_business_key) AS loyalty_members,
    {money_avg(*_ALL)} AS avg_lifetime_spend,
    {ratio('count(DISTINCT CASE WHEN is_cross_category = 1 THEN customer_business_key END)',
           'count(DISTINCT customer_business_key)')} AS cross_shop_pct,
    {round6(divide(divide(*_ONE), divide(*_NONE)))} AS cross_shop_multiple
  FROM dim_customer GROUP BY 1),
active AS (SELECT c.loyalty_tier, year(t.transaction_date) AS year, count(DISTINCT t.customer_id) AS active_customers
  FROM fact_sales_transaction t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id GROUP BY 1, 2)""")
SQL["loyalty_members_by_month"] = oracle(f"""
SELECT coalesce(g.segment, a.segment) AS segment, coalesce(g.month, a.month) AS month, a.loyalty_txns, g.loyalty_members
FROM (SELECT * FROM members CROSS JOIN (SELECT DISTINCT month FROM cal)) g
FULL JOIN txns a ON g.segment IS NOT DISTINCT FROM a.segment AND g.month = a.month""", f"""
members AS (SELECT segment, count(DISTINCT customer_business_key) AS loyalty_members
  FROM dim_customer WHERE loyalty_tier <> 'Bronze' GROUP BY 1),
txns AS (SELECT c.segment, {MONTH.format(d='t.transaction_date')} AS month,
    count(DISTINCT CASE WHEN is_loyalty_transaction = 1 THEN transaction_id END) AS loyalty_txns
  FROM fact_sales_transaction t JOIN dim_customer c ON t.customer_id = c.customer_id
  WHERE c.loyalty_tier <> 'Bronze' GROUP BY 1, 2)""")

Q["inventory_value_py"] = lambda spark, sf: X.stock_with_prior_year(star(spark, sf), ["banner_name"])
SQL["inventory_value_py"] = oracle(f"""
SELECT coalesce(c.banner_name, p.banner_name) AS banner_name, coalesce(c.year, p.year + 1) AS year,
       {cents('c.v')} AS inventory_value, {cents('p.v')} AS inventory_value_py
FROM ends c FULL JOIN ends p ON c.banner_name IS NOT DISTINCT FROM p.banner_name AND c.year = p.year + 1
WHERE c.year IS NOT NULL OR p.year + 1 <= (SELECT year(last_day) FROM cal_ends)""", _STOCK + """,
ends AS (SELECT banner_name, year, arg_max(v, d) AS v FROM stock GROUP BY 1, 2)""")

Q["inventory_value_ytd"] = lambda spark, sf: X.stock_to_date(star(spark, sf), ["banner_name"])
SQL["inventory_value_ytd"] = oracle(f"""
SELECT b.banner_name, m.month, {cents('(SELECT arg_max(v, d) FROM stock k WHERE k.banner_name IS NOT DISTINCT FROM b.banner_name AND k.year = year(m.month) AND k.month <= m.month)')}
       AS inventory_value_to_date
FROM (SELECT DISTINCT banner_name FROM stock) b, (SELECT DISTINCT month FROM cal) m
WHERE EXISTS (SELECT 1 FROM stock k WHERE k.banner_name IS NOT DISTINCT FROM b.banner_name AND k.year = year(m.month)
              AND k.month <= m.month)""", _STOCK)


def _rolling_sql(fact, col, name, by=None):
    b, on = (f"b.{by}, ", f"f.{by} IS NOT DISTINCT FROM b.{by} AND ") if by else ("", "")
    groups = f", (SELECT DISTINCT {by} FROM f WHERE member IS NOT NULL) b" if by else ""
    return oracle(f"""
SELECT {b}m.month, count(DISTINCT f.member) AS {name}
FROM (SELECT DISTINCT month FROM cal) m {groups}
LEFT JOIN f ON {on}f.month <= m.month AND f.month > m.month - INTERVAL 3 MONTH GROUP BY ALL""", f"""
f AS (SELECT {'s.banner_name, ' if by else ''}{MONTH.format(d='t.transaction_date')} AS month, t.{col} AS member
      FROM {fact} t {'LEFT JOIN dim_store s ON t.store_id = s.store_id' if by else ''})""")


Q["rolling_active_customers"] = lambda spark, sf: X.rolling_distinct(
    star(spark, sf), M.TXN, "customer_id", [], 3, "active_customers_3m")
SQL["rolling_active_customers"] = _rolling_sql("fact_sales_transaction", "customer_id", "active_customers_3m")
Q["rolling_skus_by_banner"] = lambda spark, sf: X.rolling_distinct(
    star(spark, sf), M.LINE, "product_id", ["banner_name"], 3, "skus_3m")
SQL["rolling_skus_by_banner"] = _rolling_sql("fact_sales_line_item", "product_id", "skus_3m", "banner_name")

Q["same_store_by_banner"] = lambda spark, sf: A.same_store(star(spark, sf), by=["banner_name"])
SQL["same_store_by_banner"] = oracle(f"""
SELECT s.banner_name, c.year, {cents('sum(c.s)')} AS same_store_sales, {cents('sum(p.s)')} AS same_store_sales_py,
       {ratio('sum(c.s) - sum(p.s)', 'sum(p.s)')} AS same_store_growth
FROM sy c JOIN sy p ON p.store_id = c.store_id AND p.year = c.year - 1 LEFT JOIN dim_store s ON s.store_id = c.store_id
GROUP BY 1, 2""", _SSY)

Q["gm_bridge_by_banner"] = lambda spark, sf: A.gm_bridge_rounded(star(spark, sf), by=["banner_name"])
_BRB = (_BR.replace("SELECT product_id, year(transaction_date)", "SELECT s.banner_name, product_id, year(transaction_date)")
        .replace("FROM fact_sales_line_item GROUP BY 1, 2)",
                 "FROM fact_sales_line_item l LEFT JOIN dim_store s ON l.store_id = s.store_id GROUP BY 1, 2, 3)")
        .replace("t AS (SELECT coalesce", "t AS (SELECT coalesce(c.banner_name, p.banner_name) AS banner_name, coalesce")
        .replace("ON c.product_id = p.product_id", "ON c.banner_name IS NOT DISTINCT FROM p.banner_name AND c.product_id = p.product_id")
        .replace("agg AS (SELECT year,", "agg AS (SELECT banner_name, year,")
        .replace("FROM t GROUP BY 1)", "FROM t GROUP BY 1, 2 HAVING count(gm2) > 0)")
        .replace("br AS (SELECT year,", "br AS (SELECT banner_name, year,"))
SQL["gm_bridge_by_banner"] = oracle(f"""
SELECT banner_name, year, {", ".join(f"{_c2(c)} AS {c}" for c in ("gm", "gm_py", "volume", "mix", "price", "markdown", "cost"))}
FROM br""", _BRB)
Q["pareto_filtered"] = lambda spark, sf: A.pareto(star(spark, sf), "product_name", where=Where(
    ("banner_name",), F.col("banner_name").isin("NATION_01", "NATION_02") | (F.col("banner_name") > "N")))
SQL["pareto_filtered"] = oracle(f"""
SELECT product_name, {cents('sn')} AS net_sales, {ratio('sum(sn) OVER (ORDER BY sn DESC RANGE UNBOUNDED PRECEDING)', 'sum(sn) OVER ()')}
  AS running_share
FROM (SELECT p.product_name, {N_NET} AS sn FROM {LINE_PROD} LEFT JOIN dim_store s ON l.store_id = s.store_id
      WHERE s.banner_name IN ('NATION_01', 'NATION_02') OR s.banner_name > 'N' GROUP BY 1)""")
