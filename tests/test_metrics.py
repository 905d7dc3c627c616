"""Metric edge cases on a literal star: ties, zero denominators, leap day,
missing prior year, totals of distinct counts, to-date distinct counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.plans import analysis as A
from strata.plans import metrics as M
from strata.plans import timecalc as T
from strata.plans.star import Star
from strata.sources import fixtures as FX

d = dt.date.fromisoformat
LINE_SCHEMA = ("transaction_id long, transaction_date date, store_id long, product_id long, customer_id long, "
               "quantity long, unit_list_price_cad double, unit_discount_cad double, line_subtotal_cad double, "
               "line_cost_cad double, promotion_id int")
TXN_SCHEMA = ("transaction_id long, transaction_date date, customer_id long, store_id long, channel string, "
              "total_amount_cad double, is_loyalty_transaction int")


@pytest.fixture(scope="module")
def star(spark):
    line = spark.createDataFrame([
        (1, d("2023-02-28"), 1, 10, 100, 2, 5.0, 0.0, 10.0, 6.0, None),
        (2, d("2024-02-29"), 1, 10, 100, 1, 5.0, 0.0, 5.0, 3.0, None),
        (3, d("2024-03-01"), 2, 11, None, 3, 4.0, 1.0, 9.0, 9.0, 25),
        (4, d("2024-03-02"), 2, 12, 101, 1, 9.0, 0.0, 9.0, 1.0, None),
        (5, d("2024-03-03"), 1, 13, 101, 1, 1.0, 0.0, 1.0, 1.0, None),
    ], LINE_SCHEMA)
    txn = spark.createDataFrame([
        (1, d("2023-02-28"), 100, 1, "web", 10.0, 1), (2, d("2024-02-29"), 100, 1, "web", 5.0, 1),
        (3, d("2024-03-01"), None, 2, "store", 9.0, 0), (4, d("2024-03-02"), 101, 2, "store", 9.0, 1),
        (5, d("2024-03-03"), 101, 1, "web", 1.0, 0),
    ], TXN_SCHEMA)
    store = spark.createDataFrame([(1, "S1", 1, "B1", "P1"), (2, "S2", 2, "B2", "P2")],
                                  "store_id long, store_number string, banner_id int, banner_name string, "
                                  "province_code string")
    product = spark.createDataFrame([(10, "A", "c1", 1), (11, "B", "c1", 0), (12, "C", "c2", 0), (13, "D", "c2", 0)],
                                    "product_id long, product_name string, category_name string, is_own_brand int")
    banner = spark.createDataFrame([(1, "B1", "X"), (2, "B2", "Y")], "banner_id int, banner_name string, "
                                   "banner_category string")
    cust = spark.createDataFrame([(100, "c100", "Gold", 1), (101, "c101", "Bronze", 0)],
                                 "customer_id long, customer_business_key string, loyalty_tier string, "
                                 "is_cross_category int")
    tables = {"fact_sales_line_item": line, "fact_sales_transaction": txn, "dim_store": store,
              "dim_product": product, "dim_banner": banner, "dim_customer": cust}
    return Star(tables, FX.FACT_DATES, FX.FACT_KEYS, FX.ATTRS, FX.HOPS)


def test_zero_denominator_is_blank(spark, star):
    z = star.with_table("fact_sales_line_item",
                        star.table("fact_sales_line_item").withColumn("line_subtotal_cad", F.lit(0.0)))
    out = M.evaluate(z, ["gross_margin_pct"], ["year"]).collect()
    assert all(r["gross_margin_pct"] is None for r in out)


def test_guest_customers_not_counted(star):
    out = M.evaluate(star, ["active_customers", "transactions"], []).collect()[0]
    assert (out["active_customers"], out["transactions"]) == (2, 5)


def test_rollup_distinct_totals_reaggregate(star):
    out = M.evaluate(star, ["active_customers"], ["channel"], grouping="rollup")
    got = {r["channel"]: r["active_customers"] for r in out.collect()}
    assert got == {"web": 2, "store": 1, None: 2}  # total is not 2 + 1


def test_leap_day_prior_year_at_month_grain(star):
    out = T.with_prior_year(star, ["net_sales"], [], "month")
    got = {r["month"]: (r["net_sales"], r["net_sales_py"]) for r in out.collect()}
    assert got[d("2024-02-01")] == (5.0, 10.0)   # Feb 2024 (29 days) vs Feb 2023
    assert got[d("2023-02-01")] == (10.0, None)  # no prior year -> blank


def test_changes_are_rounded_once(spark, star):
    txn = spark.createDataFrame(
        [(i, d("2023-05-01"), 100, 1, "web", x, 0) for i, x in enumerate([0.33, 0.33, 0.34])]
        + [(9, d("2024-05-01"), 100, 1, "web", 0.5, 1)], TXN_SCHEMA)
    s = star.with_table("fact_sales_transaction", txn)
    out = T.with_prior_year(s, ["avg_txn_value", "loyalty_txn_pct"], [], "year", shown=F.col("year") == 2024, changes={
        "pct": ("avg_txn_value", T.yoy_pct), "abs": ("avg_txn_value", T.yoy),
        "points": ("loyalty_txn_pct", T.delta_points)}).collect()[0]
    assert (out["avg_txn_value"], out["avg_txn_value_py"]) == (0.5, 0.33)
    assert (out["pct"], out["abs"], out["points"]) == (0.5, 0.166667, 100.0)  # of 1/3, not of 0.33


def test_yoy_pct_blank_without_prior(star):
    out = T.with_prior_year(star, ["net_sales"], [], "year")
    assert {r["year"] for r in out.collect()} == {2023, 2024}
    pct = out.select("year", T.yoy_pct(F.col("net_sales"), F.col("net_sales_py")).alias("p")).collect()
    got = {r["year"]: r["p"] for r in pct}
    assert got[2023] is None and got[2024] == pytest.approx((24.0 - 10.0) / 10.0)


def test_ytd_distinct_matches_brute_force(star):
    out = T.to_date(star, ["active_customers", "net_sales"], [], "year", "month")
    got = {r["month"]: (r["active_customers"], r["net_sales"]) for r in out.collect()}
    assert got[d("2024-02-01")] == (1, 5.0)
    assert got[d("2024-03-01")] == (2, 24.0)   # customers 100 and 101 so far in 2024


def test_top_n_keeps_ties(spark, star):
    line = spark.createDataFrame([
        (1, d("2024-01-01"), 1, 10, None, 1, 1.0, 0.0, 5.0, 1.0, None),
        (2, d("2024-01-01"), 1, 11, None, 1, 1.0, 0.0, 5.0, 1.0, None),
        (3, d("2024-01-01"), 1, 12, None, 1, 1.0, 0.0, 1.0, 1.0, None)], LINE_SCHEMA)
    s = star.with_table("fact_sales_line_item", line)
    out = A.top_n_sales(s, "product_name", [], 1).collect()[0]
    assert (out["members"], out["top_n_sales"]) == (2, 10.0)
    p = {r["product_name"]: r["running_share"] for r in A.pareto(s, "product_name").collect()}
    assert p == {"A": pytest.approx(10 / 11, abs=1e-6), "B": pytest.approx(10 / 11, abs=1e-6), "C": 1.0}


def test_running_share_many_buckets(spark):
    vals = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 2, 1000, 1e6, 1e6, 0, 5])],
                                 "id long, s double")
    out = {r["id"]: r["running_share"] for r in A.running_share(vals, "s").collect()}
    tot = sum([1, 1, 2, 1000, 1e6, 1e6, 0, 5])
    assert out[4] == out[5] == pytest.approx(2e6 / tot, abs=1e-6)
    assert out[6] == 1.0 and out[0] == out[1] == 1.0
    assert out[3] == pytest.approx((2e6 + 1000) / tot, abs=1e-6)


def test_bridge_reconciles(spark):
    from strata.sources.fixtures import retail_star
    from tests.conftest import SF01
    chk = A.gm_bridge_check(retail_star(spark, SF01)).where(F.col("balanced").isNotNull()).collect()
    assert chk and all(r["balanced"] for r in chk)


def test_top_n_parameter_validated():
    assert A.top_n_parameter() == 10 and A.top_n_parameter(25) == 25
    with pytest.raises(ValueError):
        A.top_n_parameter(7)


def test_unique_key_count_equals_distinct_count(star):
    uniq = Star(star.tables, star.fact_dates, star.fact_keys, star.attrs, star.hops,
                {"fact_sales_transaction": ("transaction_id",)})
    a = M.evaluate(star, ["transactions", "loyalty_txns"], ["channel"]).collect()
    b = M.evaluate(uniq, ["transactions", "loyalty_txns"], ["channel"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    ya = T.to_date(star, ["transactions"], [], "year", "month").collect()
    yb = T.to_date(uniq, ["transactions"], [], "year", "month").collect()
    assert sorted(map(tuple, ya)) == sorted(map(tuple, yb))


def test_prior_year_at_day_grain_has_one_row_per_day(spark, star):
    line = spark.createDataFrame([
        (1, d("2024-02-28"), 1, 10, None, 1, 1.0, 0.0, 2.0, 1.0, None),
        (2, d("2024-02-29"), 1, 10, None, 1, 1.0, 0.0, 3.0, 1.0, None),
        (3, d("2025-02-28"), 1, 10, None, 1, 1.0, 0.0, 7.0, 1.0, None)], LINE_SCHEMA)
    s = star.with_table("fact_sales_line_item", line)
    out = T.with_prior_year(s, ["net_sales"], [], "date").collect()
    got = {r["date"]: (r["net_sales"], r["net_sales_py"]) for r in out}
    assert len(out) == 3
    assert got[d("2025-02-28")] == (7.0, 2.0)   # same calendar day last year
    assert got[d("2024-02-29")] == (3.0, None)  # 2023-02-28 had no sales


def test_cube_and_grouping_sets_reaggregate(star):
    out = M.evaluate(star, ["active_customers", "net_sales"], ["loyalty_tier", "year"], grouping="cube").collect()
    by_gid = {}
    for r in out:
        by_gid.setdefault(r["grouping_id"], []).append(r)
    assert sorted(by_gid) == [0, 1, 2, 3]
    total = by_gid[3][0]
    assert total["active_customers"] == 2 and total["net_sales"] == 34.0
    sets = M.evaluate(star, ["active_customers"], ["loyalty_tier", "year"], sets=[["loyalty_tier"], []]).collect()
    got = {(r["loyalty_tier"], r["grouping_id"]): r["active_customers"] for r in sets}
    assert got == {("Gold", 1): 1, ("Bronze", 1): 1, (None, 1): 0, (None, 3): 2}
