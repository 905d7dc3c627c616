"""Row/column security semantics and KPI text formatting on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import security as S
from strata.plans import kpi as K
from strata.plans import metrics as M
from strata.plans.star import Star
from strata.sources import fixtures as FX

d = dt.date.fromisoformat


def _star(spark):
    txn = spark.createDataFrame([
        (1, d("2024-01-01"), 10, 1, "web", 10.0, 1), (2, d("2024-01-01"), 11, 2, "web", 20.0, 0),
        (3, d("2024-01-01"), 12, None, "web", 40.0, 0), (4, d("2024-01-01"), 13, 9, "web", 80.0, 0)],
        "transaction_id long, transaction_date date, customer_id long, store_id long, channel string, "
        "total_amount_cad double, is_loyalty_transaction int")
    store = spark.createDataFrame([(1, "S1", 1, "B1", "AB"), (2, "S2", 2, "B2", "BC")],
                                  "store_id long, store_number string, banner_id int, banner_name string, "
                                  "province_code string")
    banner = spark.createDataFrame([(1, "B1", "Cannabis"), (2, "B2", "Liquor")],
                                   "banner_id int, banner_name string, banner_category string")
    return Star({"fact_sales_transaction": txn, "dim_store": store, "dim_banner": banner},
                FX.FACT_DATES, FX.FACT_KEYS, FX.ATTRS, FX.HOPS)


def test_row_filters_drop_null_and_unmatched_keys(spark):
    star = _star(spark)
    full = M.evaluate(star, ["revenue_incl_tax"], []).collect()[0]["revenue_incl_tax"]
    assert full == 150.0
    ab = M.evaluate(S.rls_region(star, "AB"), ["revenue_incl_tax"], []).collect()[0]["revenue_incl_tax"]
    assert ab == 10.0  # the NULL store and the unknown store 9 disappear
    liquor = M.evaluate(S.rls_banner(star, "Liquor"), ["revenue_incl_tax"], []).collect()[0]["revenue_incl_tax"]
    assert liquor == 20.0
    m = S.user_banner_map(spark, [("a@x", 1), ("a@x", 2), ("b@x", 2)])
    a = M.evaluate(S.rls_dynamic(star, m, "a@x"), ["revenue_incl_tax"], []).collect()[0]["revenue_incl_tax"]
    b = M.evaluate(S.rls_dynamic(star, m, "b@x"), ["revenue_incl_tax"], []).collect()[0]["revenue_incl_tax"]
    assert (a, b) == (30.0, 20.0)


def test_column_security_hides_pii(spark):
    df = spark.createDataFrame([(1, "x", "e", "p")], "customer_id long, segment string, email_hash string, "
                                                     "phone_hash string")
    assert S.ols_drop(df).columns == ["customer_id", "segment"]


def test_kpi_value_and_chip_text(spark):
    df = spark.createDataFrame([(1234567.0, 0.1234), (999.0, None), (2.25, -0.00004), (1.5e9, 0.0)],
                               "v double, d double")
    out = df.select(K.value_text(F.col("v"), "money_short").alias("a"), K.value_text(F.col("v"), "num2").alias("b"),
                    K.chip_text(F.col("d"), "pct").alias("c"), K.chip_text(F.col("d"), "pts").alias("p")).collect()
    assert [r["a"] for r in out] == ["$1.2M", "$999", "$2", "$1.5B"]
    assert out[2]["b"] == "2.25" and out[0]["b"] == "1234567.00"
    assert [r["c"] for r in out] == ["+12.3% vs PY", "no PY data", "-0.0% vs PY", "+0.0% vs PY"]
    assert out[0]["p"] == "+0.1 pts vs PY"
    money2 = df.select(K.value_text(F.col("v"), "money2").alias("m")).collect()[0]["m"]
    assert money2 == "$1,234,567.00"


def test_share_totals_keep_null_groups(spark):
    from strata.plans import analysis as A
    from strata.plans.star import Star
    rows = [(None, "a", 1.0), (None, "b", 3.0), ("x", "a", 2.0)]
    star = Star({"fact_sales_line_item": spark.createDataFrame(rows, "g string, m string, line_subtotal_cad double")},
                {}, {"fact_sales_line_item": {}}, {})
    kept = {(r.g, r.m): r.share for r in A.share_of_total(star, ["g", "m"], ["m"]).collect()}
    assert kept == {(None, "a"): 0.25, (None, "b"): 0.75, ("x", "a"): 1.0}
    assert sorted(r.share for r in A.share_of_total(star, ["g"], ["g"]).collect()) == [0.333333, 0.666667]
