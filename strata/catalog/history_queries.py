"""Upsert, change capture, SCD2, overlay, quality and effective-date queries
(C01-C17, D01-D11, E01-E07) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.catalog.prelude import oracle
from strata.catalog.sqlfrag import cents, msum
from strata.operators import history as H
from strata.operators import merge as MG
from strata.operators import quality as DQ
from strata.sources import fixtures as FX
from strata.sources.tables import read_table

Q: dict = {}
SQL: dict = {}

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
OC = ", ".join(ORDER_COLS)

FIX_CTES = f"""
tgt AS (SELECT {OC} FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
src AS (SELECT {OC} FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
        UNION ALL
        SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice + 1.0::DOUBLE END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' AND o_orderstatus = 'P'),
merged AS (SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       {", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ORDER_COLS[1:])}
       FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey),
newv AS (SELECT * FROM merged
         WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01')),
customer_year AS (
  SELECT customer_id, yr, CASE WHEN spend < 300000 THEN 'Bronze' WHEN spend < 600000 THEN 'Silver' ELSE 'Gold' END
         AS loyalty_tier, make_date(yr, 1, 1) AS image_date
  FROM (SELECT o_custkey AS customer_id, CAST(year(o_orderdate) AS INTEGER) AS yr, {cents(msum('o_totalprice'))} AS spend
        FROM orders GROUP BY 1, 2)),
cy_hash AS (SELECT *, sha256(concat_ws('||', coalesce(CAST(loyalty_tier AS VARCHAR), '∅'))) AS scd_hash
            FROM customer_year),
cust_versions AS (
  SELECT customer_id, loyalty_tier, scd_hash, image_date AS effective_from,
         coalesce(lead(image_date) OVER (PARTITION BY customer_id ORDER BY image_date), DATE '9999-12-31') AS effective_to
  FROM (SELECT *, lag(scd_hash) OVER (PARTITION BY customer_id ORDER BY image_date) AS prev FROM cy_hash)
  WHERE prev IS NULL OR prev <> scd_hash),
pchg AS (
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR) AS business_key, 'list_price_cad' AS attribute,
         CAST(p_retailprice + 5 AS VARCHAR) AS new_value, DATE '1998-01-01' AS Processing_Date FROM part WHERE p_size > 45
  UNION ALL
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR), 'list_price_cad', CAST(p_retailprice + 7 AS VARCHAR), DATE '1998-02-01'
  FROM part WHERE p_size > 45
  UNION ALL
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR), 'brand', p_brand || '-X', DATE '1998-01-15'
  FROM part WHERE starts_with(p_type, 'PROMO')
  UNION ALL
  SELECT 'SKU-' || CAST(p_partkey AS VARCHAR), 'product_name', NULL, DATE '1998-01-20'
  FROM part WHERE starts_with(p_type, 'SMALL')),
platest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY business_key, attribute
                                      ORDER BY Processing_Date DESC, new_value DESC NULLS LAST) AS rn FROM pchg)
            WHERE rn = 1),
overlay AS (
  SELECT p.product_id, p.sku,
         CASE WHEN n.business_key IS NOT NULL THEN n.new_value ELSE p.product_name END AS product_name,
         CASE WHEN b.business_key IS NOT NULL THEN b.new_value ELSE p.brand END AS brand,
         p.category_name,
         CASE WHEN l.business_key IS NOT NULL THEN TRY_CAST(l.new_value AS DOUBLE) ELSE p.list_price_cad END
           AS list_price_cad,
         p.cost_price_cad, p.is_own_brand
  FROM dim_product p
  LEFT JOIN (SELECT * FROM platest WHERE attribute = 'product_name') n ON p.sku = n.business_key
  LEFT JOIN (SELECT * FROM platest WHERE attribute = 'brand') b ON p.sku = b.business_key
  LEFT JOIN (SELECT * FROM platest WHERE attribute = 'list_price_cad') l ON p.sku = l.business_key)
"""


def fx_oracle(body: str, extra: str = "") -> str:
    return oracle(body, FIX_CTES + ("," + extra if extra.strip() else ""))


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select(*ORDER_COLS)


def _merged(spark, sf):
    o = _orders(spark, sf)
    return MG.merge_upsert(FX.upsert_target(o), FX.upsert_source(o), "o_orderkey")


def _newv(merged):
    gone = ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
            & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")))
    return merged.where(~gone)


# --- C01-C04 ------------------------------------------------------------------
Q["merge_upsert"] = _merged
SQL["merge_upsert"] = fx_oracle("SELECT * FROM merged")


def _upsert_cols(spark, sf):
    o = _orders(spark, sf)
    return MG.merge_upsert(FX.upsert_target(o), FX.upsert_source(o), "o_orderkey", update_cols=["o_totalprice"])


Q["merge_upsert_cols"] = _upsert_cols
SQL["merge_upsert_cols"] = fx_oracle(f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  {", ".join(f"CASE WHEN t.o_orderkey IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in ORDER_COLS[1:] if c != "o_totalprice")},
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey""")


def _merge_metrics(spark, sf):
    o = _orders(spark, sf)
    return MG.merge_metrics(FX.upsert_target(o), FX.upsert_source(o), "o_orderkey")


Q["merge_metrics"] = _merge_metrics
SQL["merge_metrics"] = fx_oracle("""
SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted, count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updated
FROM (SELECT DISTINCT o_orderkey FROM src) s LEFT JOIN (SELECT DISTINCT o_orderkey FROM tgt) t USING (o_orderkey)""")

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _dedup(spark, sf):
    li = read_table(spark, sf, "lineitem").select(*LI_COLS)
    return MG.dedup_latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate")


Q["dedup_latest"] = _dedup
_TIE = ", ".join(f"{c} DESC NULLS LAST" for c in LI_COLS if c not in ("l_orderkey", "l_linenumber", "l_shipdate"))
SQL["dedup_latest"] = f"""
SELECT {", ".join(LI_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {_TIE}) AS rn
  FROM lineitem) WHERE rn = 1"""


# --- C05: landing -> bronze (incremental scan + dedup + upsert) ------------------
def _landing_to_bronze(spark, sf):
    from strata.sources.landing import landing_to_bronze
    landed = FX.order_batches(_orders(spark, sf))
    wm = "2001-03-01"
    bronze = MG.dedup_latest(landed.where(F.col("Processing_Date") <= F.lit(wm).cast("date")),
                             "o_orderkey", "Processing_Date")
    return landing_to_bronze(bronze, landed, "o_orderkey", wm)


Q["landing_to_bronze"] = _landing_to_bronze
SQL["landing_to_bronze"] = f"""
WITH landed AS (SELECT {OC}, CASE WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN DATE '2000-12-31'
                   ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS Processing_Date FROM orders)
SELECT * FROM landed"""

# --- C06 / A08 -----------------------------------------------------------------


def _change_feed(spark, sf):
    o = _orders(spark, sf)
    return MG.change_feed(FX.upsert_target(o), _newv(_merged(spark, sf)), "o_orderkey")


_DIFF = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in ORDER_COLS[1:])
Q["change_feed"] = _change_feed
SQL["change_feed"] = fx_oracle(f"""
SELECT n.*, 'insert' AS _change_type FROM newv n WHERE NOT EXISTS (SELECT 1 FROM tgt o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL
SELECT o.*, 'delete' FROM tgt o WHERE NOT EXISTS (SELECT 1 FROM newv n WHERE o.o_orderkey = n.o_orderkey)
UNION ALL
SELECT o.*, 'update_preimage' FROM tgt o JOIN newv n ON o.o_orderkey = n.o_orderkey WHERE {_DIFF}
UNION ALL
SELECT n.*, 'update_postimage' FROM tgt o JOIN newv n ON o.o_orderkey = n.o_orderkey WHERE {_DIFF}""")


def _read_changes(spark, sf):
    return MG.read_changes(_change_feed(spark, sf).withColumn("_commit_version", F.lit(1).cast("bigint")), 1)


Q["read_changes"] = _read_changes
SQL["read_changes"] = fx_oracle(f"""
SELECT n.*, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM newv n
WHERE NOT EXISTS (SELECT 1 FROM tgt o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL
SELECT n.*, 'update_postimage', CAST(1 AS BIGINT) FROM tgt o JOIN newv n ON o.o_orderkey = n.o_orderkey WHERE {_DIFF}""")

# --- C07-C13: SCD2 ---------------------------------------------------------------


def _star(spark, sf):
    return FX.retail_star(spark, sf)


def _scd_hash(spark, sf):
    c = _star(spark, sf).table("dim_customer").select(
        "customer_business_key", "segment", "loyalty_tier", "enrollment_date", "is_cross_category")
    attrs = H.tracked(c, "customer_business_key", None)
    return c.select("customer_business_key", H.scd_hash(attrs).alias("scd_hash"))


Q["scd_hash"] = _scd_hash
SQL["scd_hash"] = oracle("""
SELECT customer_business_key, sha256(concat_ws('||', coalesce(CAST(segment AS VARCHAR), '∅'),
  coalesce(CAST(loyalty_tier AS VARCHAR), '∅'), coalesce(CAST(enrollment_date AS VARCHAR), '∅'),
  coalesce(CAST(is_cross_category AS VARCHAR), '∅'))) AS scd_hash
FROM dim_customer""")


def _cy(spark, sf):
    return FX.customer_year(read_table(spark, sf, "orders"))


def _image(cy, yr):
    return cy.where(F.col("yr") == yr).select("customer_id", "loyalty_tier")


def _initial(spark, sf):
    return H.scd2_initial(_image(_cy(spark, sf), 1995), "customer_id", ["loyalty_tier"], "1995-01-01")


V_COLS = "customer_id, loyalty_tier, scd_hash, effective_from, effective_to"
Q["scd2_initial"] = _initial
SQL["scd2_initial"] = fx_oracle("""
SELECT customer_id, loyalty_tier, scd_hash, DATE '1995-01-01' AS effective_from, DATE '9999-12-31' AS effective_to,
       true AS is_current FROM cy_hash WHERE yr = 1995""")


def _changed(spark, sf):
    return H.scd2_changed(_image(_cy(spark, sf), 1996), _initial(spark, sf), "customer_id", ["loyalty_tier"])


Q["scd2_changed"] = _changed
SQL["scd2_changed"] = fx_oracle("""
SELECT n.customer_id, n.loyalty_tier, n.scd_hash FROM cy_hash n JOIN cy_hash o
  ON n.customer_id = o.customer_id AND o.yr = 1995 WHERE n.yr = 1996 AND n.scd_hash <> o.scd_hash""")


def _apply(spark, sf):
    return H.apply_scd2(_initial(spark, sf), _image(_cy(spark, sf), 1996), "customer_id", ["loyalty_tier"],
                        "1996-01-01")


Q["scd2_apply"] = _apply
SQL["scd2_apply"] = fx_oracle("""
SELECT o.customer_id, o.loyalty_tier, o.scd_hash, DATE '1995-01-01' AS effective_from,
       CASE WHEN n.scd_hash IS NOT NULL AND n.scd_hash <> o.scd_hash THEN DATE '1996-01-01' ELSE DATE '9999-12-31' END
         AS effective_to,
       NOT (n.scd_hash IS NOT NULL AND n.scd_hash <> o.scd_hash) AS is_current
FROM cy_hash o LEFT JOIN (SELECT * FROM cy_hash WHERE yr = 1996) n ON o.customer_id = n.customer_id WHERE o.yr = 1995
UNION ALL
SELECT n.customer_id, n.loyalty_tier, n.scd_hash, DATE '1996-01-01', DATE '9999-12-31', true
FROM cy_hash n WHERE n.yr = 1996 AND NOT EXISTS (
  SELECT 1 FROM cy_hash o WHERE o.yr = 1995 AND o.customer_id = n.customer_id AND o.scd_hash = n.scd_hash)""")


def _versions(spark, sf):
    cy = _cy(spark, sf).select("customer_id", "loyalty_tier", "image_date")
    return H.scd2_from_history(cy, "customer_id", ["loyalty_tier"], "image_date")


Q["scd2_from_history"] = _versions
SQL["scd2_from_history"] = fx_oracle(f"""
SELECT {V_COLS}, effective_to = DATE '9999-12-31' AS is_current FROM cust_versions""")

LATE_YEARS = (1997, 2000)  # fixed values of the fixture: images that come after all others


def _late(spark, sf):
    """Versions from all images but two, then these two, late; with the fact rows
    whose key they change."""
    from strata.sources.landing import publish
    cy = publish(_cy(spark, sf).select("customer_id", "loyalty_tier", "image_date"), "customer_images", spark=spark)
    is_late = F.year("image_date").isin(*LATE_YEARS)
    seen = cy.where(~is_late)
    table = publish(H.scd2_from_history(seen, "customer_id", ["loyalty_tier"], "image_date"), "late_0", spark=spark)
    first = table
    for year in sorted(LATE_YEARS, reverse=True):
        image = cy.where(F.year("image_date") == year)
        table = publish(H.apply_image(table, seen, image.drop("image_date"), "customer_id", ["loyalty_tier"],
                                      f"{year}-01-01", "image_date"), f"late_{year}", spark=spark)
        seen = seen.unionByName(image)
    return first, table


Q["scd2_late_image"] = lambda spark, sf: _late(spark, sf)[1]
SQL["scd2_late_image"] = fx_oracle(f"""
SELECT {V_COLS}, effective_to = DATE '9999-12-31' AS is_current FROM cust_versions""")


def _restated(spark, sf):
    first, table = (H.gold_dim_scd2(v, "customer", "customer_id") for v in _late(spark, sf))
    t = _star(spark, sf).table("fact_sales_transaction").select("transaction_id", "customer_id", "transaction_date")
    keyed = H.effective_join(t, first.hint("merge"), "customer_id", "transaction_date", "customer")
    out = H.restate_keys(keyed, first, table, "customer_id", "transaction_date", "customer")
    start = table.select("customer_sk", F.col("effective_from").alias("customer_version_from"))
    return out.join(start.hint("merge"), "customer_sk", "left").drop("customer_sk")


Q["gold_restated"] = _restated
_LATE_SQL = ", ".join(map(str, LATE_YEARS))
SQL["gold_restated"] = fx_oracle("""
SELECT t.transaction_id, t.customer_id, t.transaction_date, v.effective_from AS customer_version_from
FROM fact_sales_transaction t
LEFT JOIN cust_versions v ON t.customer_id = v.customer_id AND t.transaction_date >= v.effective_from
  AND t.transaction_date < v.effective_to
LEFT JOIN early e ON t.customer_id = e.customer_id AND t.transaction_date >= e.effective_from
  AND t.transaction_date < e.effective_to
WHERE v.effective_from IS DISTINCT FROM e.effective_from""", f"""
early AS (
  SELECT customer_id, image_date AS effective_from,
         coalesce(lead(image_date) OVER (PARTITION BY customer_id ORDER BY image_date), DATE '9999-12-31') AS effective_to
  FROM (SELECT *, lag(scd_hash) OVER (PARTITION BY customer_id ORDER BY image_date) AS before FROM cy_hash
        WHERE yr NOT IN ({_LATE_SQL})) WHERE before IS NULL OR before <> scd_hash)""")

Q["dim_as_of"] = lambda spark, sf: H.dim_as_of(_versions(spark, sf), "1998-06-30")
SQL["dim_as_of"] = fx_oracle(f"""
SELECT {V_COLS}, effective_to = DATE '9999-12-31' AS is_current FROM cust_versions
WHERE effective_from <= DATE '1998-06-30' AND DATE '1998-06-30' < effective_to""")

Q["dim_current"] = lambda spark, sf: H.dim_current(_versions(spark, sf))
SQL["dim_current"] = fx_oracle(f"""
SELECT {V_COLS}, true AS is_current FROM cust_versions WHERE effective_to = DATE '9999-12-31'""")


def _sk(spark, sf):
    g = H.gold_dim_scd2(_versions(spark, sf), "customer", "customer_id")
    return g.agg(F.count(F.lit(1)).alias("n_versions"), F.count_distinct("customer_sk").alias("n_distinct_sk"),
                 F.count_if(F.col("customer_sk").isNull()).alias("n_null_sk"))


Q["surrogate_key"] = _sk
SQL["surrogate_key"] = fx_oracle("""
SELECT count(*) AS n_versions, count(DISTINCT (customer_id, effective_from)) AS n_distinct_sk,
       CAST(0 AS BIGINT) AS n_null_sk FROM cust_versions""")

# --- C14: attribute-change overlay --------------------------------------------


def _overlay(spark, sf):
    dim = _star(spark, sf).table("dim_product")
    return DQ.apply_changes(dim, FX.product_changes(read_table(spark, sf, "part")), "sku")


Q["overlay_changes"] = _overlay
SQL["overlay_changes"] = fx_oracle("SELECT * FROM overlay")

# --- D01-D11: quality ------------------------------------------------------------


def _txn_dirty(spark, sf):
    o = read_table(spark, sf, "orders")
    bad = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return o.select(F.col("o_orderkey").alias("transaction_id"),
                    F.concat(F.lit("  "), F.when(bad, F.lit("not-a-time"))
                             .otherwise(F.col("o_orderdate").cast("string"))).alias("transaction_timestamp"),
                    F.col("o_orderpriority").alias("channel"))


TXN_DIRTY = """txn_dirty AS (SELECT o_orderkey AS transaction_id,
  '  ' || CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'not-a-time'
               ELSE CAST(o_orderdate AS VARCHAR) END AS transaction_timestamp, o_orderpriority AS channel FROM orders)"""


def _cleanse(spark, sf):
    return DQ.cleanse(_txn_dirty(spark, sf).withColumn("_landed_at", F.lit(None).cast("timestamp")))


Q["cleanse"] = _cleanse
SQL["cleanse"] = oracle("SELECT transaction_id, trim(transaction_timestamp) AS transaction_timestamp, trim(channel) AS channel "
                        "FROM txn_dirty", TXN_DIRTY)


def _dq_ts(spark, sf):
    clean = DQ.cleanse(_txn_dirty(spark, sf))
    return DQ.dq_split(clean, DQ.RULES["fact_sales_transaction"])[1]


Q["dq_bad_timestamp"] = _dq_ts
SQL["dq_bad_timestamp"] = oracle("""
SELECT transaction_id, trim(transaction_timestamp) AS transaction_timestamp, trim(channel) AS channel,
       ['bad_timestamp'] AS dq_reasons
FROM txn_dirty WHERE TRY_CAST(trim(transaction_timestamp) AS TIMESTAMP) IS NULL""", TXN_DIRTY)


def _customer_dirty(spark, sf):
    c = read_table(spark, sf, "customer")
    code = F.col("c_nationkey") % 10
    pc = (F.when((F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.lit(None))
          .when(F.col("c_acctbal") > 9000, F.lit("12345"))
          .otherwise(F.concat(F.lit("T"), code.cast("string"), F.lit("P 1J"), code.cast("string"))))
    return c.select(F.col("c_custkey").alias("customer_id"), pc.alias("home_postal_code"))


CUST_DIRTY = """customer_dirty AS (SELECT c_custkey AS customer_id,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < 0 THEN NULL WHEN c_acctbal > 9000 THEN '12345'
       ELSE 'T' || CAST(c_nationkey % 10 AS VARCHAR) || 'P 1J' || CAST(c_nationkey % 10 AS VARCHAR) END
    AS home_postal_code FROM customer)"""

Q["dq_postal"] = lambda spark, sf: DQ.dq_split(_customer_dirty(spark, sf), DQ.RULES["dim_customer"])[1]
SQL["dq_postal"] = oracle("""
SELECT customer_id, home_postal_code, ['malformed_postal'] AS dq_reasons FROM customer_dirty
WHERE home_postal_code IS NULL OR NOT regexp_full_match(home_postal_code, '[A-Za-z][0-9][A-Za-z] ?[0-9][A-Za-z][0-9]')""",
                          CUST_DIRTY)

Q["dq_cost_gt_list"] = lambda spark, sf: DQ.dq_split(_star(spark, sf).table("dim_product"),
                                                      DQ.RULES["dim_product"])[1]
SQL["dq_cost_gt_list"] = oracle("""
SELECT *, ['cost_gt_list'] AS dq_reasons FROM dim_product WHERE cost_price_cad > list_price_cad""")


def _lines_dirty(spark, sf):
    """Sales lines where undiscounted small lines arrive with quantity 0."""
    line = _star(spark, sf).table("fact_sales_line_item")
    zero = (F.col("unit_discount_cad") == 0) & (F.col("quantity") <= 5)
    return line.withColumn("quantity", F.when(zero, F.lit(0).cast("bigint")).otherwise(F.col("quantity")))


def _dq_quarantine(spark, sf):
    _, q = DQ.dq_split(_lines_dirty(spark, sf), DQ.RULES["fact_sales_line_item"])
    return DQ.quarantine_batch(q, "2001-03-01").select("transaction_id", "line_number", "product_id", "quantity",
                                                       "dq_reasons", "_batch")


LINES_Q = """SELECT transaction_id, line_number, product_id, CAST(0 AS BIGINT) AS quantity, ['zero_quantity'] AS dq_reasons,
       DATE '2001-03-01' AS _batch
FROM fact_sales_line_item WHERE unit_discount_cad = 0 AND quantity <= 5"""
Q["dq_quarantine"] = _dq_quarantine
SQL["dq_quarantine"] = oracle(LINES_Q)


def _dq_clean(spark, sf):
    clean, _ = DQ.dq_split(_lines_dirty(spark, sf), DQ.RULES["fact_sales_line_item"])
    return clean.groupBy("store_id").agg(F.count(F.lit(1)).alias("clean_rows"), F.sum("quantity").alias("units"))


Q["dq_clean"] = _dq_clean
SQL["dq_clean"] = oracle("""
SELECT store_id, count(*) AS clean_rows, CAST(sum(quantity) AS BIGINT) AS units FROM fact_sales_line_item
WHERE NOT (unit_discount_cad = 0 AND quantity <= 5) GROUP BY 1""")


def _reason_counts(spark, sf):
    a = DQ.dq_split(_customer_dirty(spark, sf), DQ.RULES["dim_customer"])[1]
    b = DQ.dq_split(_star(spark, sf).table("dim_product"), DQ.RULES["dim_product"])[1]
    return DQ.reason_counts(a.select("dq_reasons").unionByName(b.select("dq_reasons")))


Q["dq_reason_counts"] = _reason_counts
SQL["dq_reason_counts"] = oracle("""
SELECT 'malformed_postal' AS reason, count(*) AS rows FROM customer_dirty
WHERE home_postal_code IS NULL OR NOT regexp_full_match(home_postal_code, '[A-Za-z][0-9][A-Za-z] ?[0-9][A-Za-z][0-9]')
UNION ALL SELECT 'cost_gt_list', count(*) FROM dim_product WHERE cost_price_cad > list_price_cad""", CUST_DIRTY)


def _bronze_to_silver(spark, sf):
    """Change scan of bronze -> cleanse -> quality split -> upsert."""
    o = _orders(spark, sf)
    old_bronze = FX.upsert_target(o)
    changes = MG.read_changes(MG.change_feed(old_bronze, _newv(_merged(spark, sf)), "o_orderkey"))
    clean, _ = DQ.dq_split(DQ.cleanse(changes.drop("_change_type")), {"null_price": "o_totalprice IS NULL"})
    silver = DQ.cleanse(old_bronze)
    return MG.merge_upsert(silver, clean, "o_orderkey")


Q["bronze_to_silver"] = _bronze_to_silver
SQL["bronze_to_silver"] = fx_oracle(f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       {", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in ORDER_COLS[1:])}
FROM (SELECT o_orderkey, o_custkey, trim(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
             trim(o_orderpriority) AS o_orderpriority FROM tgt) t
FULL JOIN (SELECT o_orderkey, o_custkey, trim(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate,
                  trim(o_orderpriority) AS o_orderpriority FROM chg WHERE o_totalprice IS NOT NULL) s
  ON t.o_orderkey = s.o_orderkey""", f"""
chg AS (SELECT n.* FROM newv n WHERE NOT EXISTS (SELECT 1 FROM tgt o WHERE o.o_orderkey = n.o_orderkey)
        UNION ALL SELECT n.* FROM tgt o JOIN newv n ON o.o_orderkey = n.o_orderkey WHERE {_DIFF})""")

PRODUCT_TRACKED = ["product_name", "list_price_cad", "cost_price_cad"]


def _product_versions(spark, sf, date="1998-03-01"):
    star = _star(spark, sf)
    dim = star.table("dim_product")
    first = H.scd2_initial(dim, "sku", PRODUCT_TRACKED, "1900-01-01")
    img = DQ.apply_changes(dim, FX.product_changes(read_table(spark, sf, "part")), "sku", as_of=date)
    return H.apply_scd2(first, img, "sku", PRODUCT_TRACKED, date)


def _silver_scd2(spark, sf):
    """Image -> overlay -> quality split -> SCD2 (versions of changed products)."""
    star = _star(spark, sf)
    dim = star.table("dim_product")
    first = H.scd2_initial(dim, "sku", PRODUCT_TRACKED, "1900-01-01")
    img = DQ.apply_changes(dim, FX.product_changes(read_table(spark, sf, "part")), "sku", as_of="1998-03-01")
    clean, _ = DQ.dq_split(img, DQ.RULES["dim_product"])
    v = H.apply_scd2(first, clean, "sku", PRODUCT_TRACKED, "1998-03-01")
    return v.select("product_id", "sku", "product_name", "list_price_cad", "effective_from", "effective_to", "is_current")


_PCHANGED = ("(o.product_name IS DISTINCT FROM p.product_name OR o.list_price_cad IS DISTINCT FROM p.list_price_cad "
             "OR o.cost_price_cad IS DISTINCT FROM p.cost_price_cad)")
Q["silver_scd2"] = _silver_scd2
SQL["silver_scd2"] = fx_oracle(f"""
SELECT p.product_id, p.sku, p.product_name, p.list_price_cad, DATE '1900-01-01' AS effective_from,
       CASE WHEN o.cost_price_cad <= o.list_price_cad AND {_PCHANGED} THEN DATE '1998-03-01' ELSE DATE '9999-12-31' END
         AS effective_to,
       NOT (o.cost_price_cad <= o.list_price_cad AND {_PCHANGED}) AS is_current
FROM dim_product p JOIN overlay o ON p.sku = o.sku
UNION ALL
SELECT o.product_id, o.sku, o.product_name, o.list_price_cad, DATE '1998-03-01', DATE '9999-12-31', true
FROM dim_product p JOIN overlay o ON p.sku = o.sku WHERE o.cost_price_cad <= o.list_price_cad AND {_PCHANGED}""")

# --- E01-E07: effective-date resolution -------------------------------------------


def _cust_v(spark, sf):
    return _versions(spark, sf).withColumn("customer_version_from", F.col("effective_from"))


def _store_v(spark, sf):
    s = _star(spark, sf).table("dim_store")
    return H.scd2_initial(s, "store_number", None, "1900-01-01")


def _ej(spark, sf):
    t = _star(spark, sf).table("fact_sales_transaction").select("transaction_id", "customer_id", "transaction_date")
    return H.effective_join(t, _cust_v(spark, sf), "customer_id", "transaction_date", "customer",
                            carry=["loyalty_tier", "customer_version_from"])


Q["effective_join"] = _ej
SQL["effective_join"] = fx_oracle("""
SELECT t.transaction_id, t.customer_id, t.transaction_date, v.loyalty_tier, v.effective_from AS customer_version_from
FROM fact_sales_transaction t LEFT JOIN cust_versions v ON t.customer_id = v.customer_id
  AND t.transaction_date >= v.effective_from AND t.transaction_date < v.effective_to""")


def _keyed(fact, versions, fact_key, date_col, short, dim_key):
    """E01 with C15: the fact gets ``<short>_sk`` of the version in force; the
    version start shown is read from the gold dimension by that key."""
    dim = H.gold_dim_scd2(versions, short, dim_key)
    out = H.effective_join(fact, dim, fact_key, date_col, short)
    sk = f"{short}_sk"
    start = dim.select(sk, F.col("effective_from").alias(f"{short}_version_from"))
    return out.join(start, sk, "left").drop(sk)


def _gold_txn(spark, sf):
    t = _star(spark, sf).table("fact_sales_transaction").select("transaction_id", "store_id", "customer_id",
                                                                "transaction_date")
    t = _keyed(t, _store_v(spark, sf), "store_id", "transaction_date", "store", "store_number")
    return _keyed(t, _versions(spark, sf), "customer_id", "transaction_date", "customer", "customer_id")


_SV = "(SELECT store_id, DATE '1900-01-01' AS ef, DATE '9999-12-31' AS et FROM dim_store)"
Q["gold_transaction"] = _gold_txn
SQL["gold_transaction"] = fx_oracle(f"""
SELECT t.transaction_id, t.store_id, t.customer_id, t.transaction_date, s.ef AS store_version_from,
       v.effective_from AS customer_version_from
FROM fact_sales_transaction t
LEFT JOIN {_SV} s ON t.store_id = s.store_id AND t.transaction_date >= s.ef AND t.transaction_date < s.et
LEFT JOIN cust_versions v ON t.customer_id = v.customer_id AND t.transaction_date >= v.effective_from
  AND t.transaction_date < v.effective_to""")

_PV = f"""pv AS (
  SELECT p.product_id, DATE '1900-01-01' AS ef,
         CASE WHEN {_PCHANGED} THEN DATE '1998-03-01' ELSE DATE '9999-12-31' END AS et
  FROM dim_product p JOIN overlay o ON p.sku = o.sku
  UNION ALL
  SELECT p.product_id, DATE '1998-03-01', DATE '9999-12-31' FROM dim_product p JOIN overlay o ON p.sku = o.sku
  WHERE {_PCHANGED})"""


def _gold_line(spark, sf):
    f = _star(spark, sf).table("fact_sales_line_item").select(
        "transaction_id", "line_number", "product_id", "store_id", "customer_id", "transaction_date")
    f = _keyed(f, _store_v(spark, sf), "store_id", "transaction_date", "store", "store_number")
    f = _keyed(f, _product_versions(spark, sf), "product_id", "transaction_date", "product", "sku")
    return _keyed(f, _versions(spark, sf), "customer_id", "transaction_date", "customer", "customer_id")


Q["gold_line_item"] = _gold_line
SQL["gold_line_item"] = fx_oracle(f"""
SELECT l.transaction_id, l.line_number, l.product_id, l.store_id, l.customer_id, l.transaction_date,
       s.ef AS store_version_from, p.ef AS product_version_from, v.effective_from AS customer_version_from
FROM fact_sales_line_item l
LEFT JOIN {_SV} s ON l.store_id = s.store_id AND l.transaction_date >= s.ef AND l.transaction_date < s.et
LEFT JOIN pv p ON l.product_id = p.product_id AND l.transaction_date >= p.ef AND l.transaction_date < p.et
LEFT JOIN cust_versions v ON l.customer_id = v.customer_id AND l.transaction_date >= v.effective_from
  AND l.transaction_date < v.effective_to""", _PV)


def _gold_inv(spark, sf):
    f = _star(spark, sf).table("fact_inventory_snapshot").select("snapshot_date", "store_id", "product_id",
                                                                 "on_hand_units")
    f = _keyed(f, _store_v(spark, sf), "store_id", "snapshot_date", "store", "store_number")
    return _keyed(f, _product_versions(spark, sf), "product_id", "snapshot_date", "product", "sku")


Q["gold_inventory"] = _gold_inv
SQL["gold_inventory"] = fx_oracle(f"""
SELECT i.snapshot_date, i.store_id, i.product_id, i.on_hand_units, s.ef AS store_version_from,
       p.ef AS product_version_from
FROM fact_inventory_snapshot i
LEFT JOIN {_SV} s ON i.store_id = s.store_id AND i.snapshot_date >= s.ef AND i.snapshot_date < s.et
LEFT JOIN pv p ON i.product_id = p.product_id AND i.snapshot_date >= p.ef AND i.snapshot_date < p.et""", _PV)


def _gold_loy(spark, sf):
    f = _star(spark, sf).table("fact_loyalty_event").select("loyalty_event_id", "customer_id", "event_date",
                                                            "points_delta")
    return _keyed(f, _versions(spark, sf), "customer_id", "event_date", "customer", "customer_id")


Q["gold_loyalty"] = _gold_loy
SQL["gold_loyalty"] = fx_oracle("""
SELECT e.loyalty_event_id, e.customer_id, e.event_date, e.points_delta, v.effective_from AS customer_version_from
FROM fact_loyalty_event e LEFT JOIN cust_versions v ON e.customer_id = v.customer_id
  AND e.event_date >= v.effective_from AND e.event_date < v.effective_to""")

Q["gold_dim_simple"] = lambda spark, sf: H.gold_dim_simple(_star(spark, sf).table("dim_banner"), "banner", "banner_id")
SQL["gold_dim_simple"] = oracle("SELECT *, banner_id AS banner_sk FROM dim_banner")


def _gold_dim_scd2(spark, sf):
    v = _versions(spark, sf)
    enr = _star(spark, sf).table("dim_customer").select("customer_id", "enrollment_date")
    g = H.gold_dim_scd2(v.join(enr, "customer_id", "left"), "customer", "customer_id", month_of="enrollment_date")
    return g.select("customer_id", "loyalty_tier", "effective_from", "effective_to", "is_current", "enrollment_month")


Q["gold_dim_scd2"] = _gold_dim_scd2
SQL["gold_dim_scd2"] = fx_oracle("""
SELECT v.customer_id, v.loyalty_tier, v.effective_from, v.effective_to, v.effective_to = DATE '9999-12-31' AS is_current,
       CAST(date_trunc('month', c.enrollment_date) AS DATE) AS enrollment_month
FROM cust_versions v LEFT JOIN dim_customer c ON v.customer_id = c.customer_id""")

