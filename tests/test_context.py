"""Stock at the last snapshot in its context and rolling distinct counts, on a
star small enough to work out by hand; the bridge under two partitionings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.plans import analysis as A
from strata.plans import context as X
from strata.plans import metrics as M
from strata.plans.star import Star, Where
from strata.sources import fixtures as FX
from tests.conftest import rows


def star_of(spark, stock=(), sales=()):
    inv = spark.createDataFrame([(s, d, float(v)) for s, d, v in stock],
                                "store_id long, snapshot_date string, inventory_value_cad double")
    txn = spark.createDataFrame(list(sales), "transaction_date string, customer_id long, store_id long")
    tables = {M.INV: inv.withColumn("snapshot_date", F.col("snapshot_date").cast("date")),
              M.TXN: txn.withColumn("transaction_date", F.col("transaction_date").cast("date")),
              "dim_store": spark.createDataFrame([(1, "A"), (2, "B")], "store_id long, banner_name string")}
    keys = {M.INV: {"dim_store": "store_id"}, M.TXN: {"dim_store": "store_id"}}
    return Star(tables, {M.INV: "snapshot_date", M.TXN: "transaction_date"}, keys, {"banner_name": ("dim_store", "banner_name")})


STOCK = [(1, "2023-01-31", 10), (1, "2023-03-31", 12), (2, "2023-02-28", 7), (1, "2024-01-31", 20), (3, "2024-01-31", 5)]


def test_totals_take_their_own_last_snapshot(spark):
    got = rows(X.stock_rollup(star_of(spark, STOCK), ["banner_name", "year"]), ["grouping_id", "banner_name", "year", "inventory_value"])
    assert got == sorted([(0, "A", 2023, 12.0), (0, "A", 2024, 20.0), (0, "B", 2023, 7.0), (0, None, 2024, 5.0),
                          (1, "A", None, 20.0), (1, "B", None, 7.0), (1, None, None, 5.0), (3, None, None, 25.0)], key=repr)
    cube = rows(X.stock_rollup(star_of(spark, STOCK), ["banner_name", "year"], cube=True).where("grouping_id = 2"),
                ["year", "inventory_value"])
    assert cube == [(2023, 12.0), (2024, 25.0)]


def test_prior_year_and_to_date(spark):
    star = star_of(spark, STOCK)
    assert rows(X.stock_with_prior_year(star, ["banner_name"])) == sorted(
        [("A", 2023, 12.0, None), ("A", 2024, 20.0, 12.0), ("B", 2023, 7.0, None), ("B", 2024, None, 7.0),
         (None, 2024, 5.0, None)], key=repr)
    got = {(str(r.month)[:7], r.inventory_value_to_date) for r in X.stock_to_date(star, []).collect()}
    assert got == {("2023-01", 10.0), ("2023-02", 7.0), ("2023-03", 12.0), *((f"2023-{m:02d}", 12.0) for m in range(4, 13)),
                   ("2024-01", 25.0)}


@pytest.mark.parametrize("months", [1, 3, 12])
def test_rolling_distinct_counts_against_brute_force(spark, months):
    r = random.Random(months)
    sales = [(f"20{23 + m // 12}-{m % 12 + 1:02d}-{r.randint(1, 28):02d}", r.choice([None, *range(8)]), r.choice([1, 2, 9]))
             for m in [r.choice([0, 1, 2, 5, 6, 14, 20]) for _ in range(60)]]
    star = star_of(spark, sales=sales)
    banner = {1: "A", 2: "B"}
    at = lambda d: int(d[:4]) * 12 + int(d[5:7])
    span = range(min(at(d) for d, _, _ in sales), max(at(d) for d, _, _ in sales) + 1)
    got = {(r.banner_name, r.month.year * 12 + r.month.month): r.n
           for r in X.rolling_distinct(star, M.TXN, "customer_id", ["banner_name"], months, "n").collect()}
    want = {(b, m): len({c for d, c, s in sales if c is not None and banner.get(s) == b and m - months < at(d) <= m})
            for b in {banner.get(s) for _, c, s in sales if c is not None} for m in span}
    assert got == want
    whole = {r.month.year * 12 + r.month.month: r.n for r in X.rolling_distinct(star, M.TXN, "customer_id", [], months, "n").collect()}
    assert whole == {m: len({c for d, c, _ in sales if c is not None and m - months < at(d) <= m}) for m in span}


def test_dense_rank_by_buckets_equals_the_window(spark):
    r = random.Random(3)
    data = [(i, r.choice([None, 0, -5, 7, r.randint(-10**12, 10**12), r.randint(0, 50)])) for i in range(400)]
    df = spark.createDataFrame(data, "id long, v long")
    order = sorted({v for _, v in data if v is not None}, reverse=True)
    want = {i: len(order) + 1 if v is None else order.index(v) + 1 for i, v in data}
    assert {x.id: x.rank for x in A.dense_ranked(df, "v", "rank").collect()} == want


def test_pareto_keeps_members_without_a_value(spark):
    df = spark.createDataFrame([("a", 30000), ("b", 10000), ("c", None)], "m string, v long")
    got = {r.m: (r.v, r.running_share) for r in A.running_share(df, "v").collect()}
    assert got == {"a": (30000, 0.75), "b": (10000, 1.0), "c": (None, 1.0)}


def test_bridge_is_the_same_to_the_bit_under_two_partitionings(spark):
    r = random.Random(5)
    lines = [(f"20{20 + r.randint(0, 2)}-05-05", r.randint(1, 300), r.randint(1, 9), r.random() * 90, r.random() * 9,
              r.random() * 500, r.random() * 300) for _ in range(4000)]
    df = spark.createDataFrame(lines, "transaction_date string, product_id long, quantity long, unit_list_price_cad double, "
                               "unit_discount_cad double, line_subtotal_cad double, line_cost_cad double")
    df = df.withColumn("transaction_date", F.col("transaction_date").cast("date"))
    out = []
    for n, order in ((1, "product_id"), (13, "quantity")):
        star = Star({M.LINE: df.repartition(n, order)}, {M.LINE: "transaction_date"}, {M.LINE: {}}, {})
        out.append(rows(A.gm_bridge(star)))
    assert out[0] == out[1]


def test_customer_measures_are_the_same_in_every_period(spark):
    """No period reaches the customers: all years of the calendar show their total,
    also those in which a tier bought nothing; a filter on an attribute does reach."""
    d = dt.date.fromisoformat
    txn = spark.createDataFrame([(1, d("2022-05-01"), 1, 1, "web", 1.0, 1), (2, d("2024-02-01"), 2, 1, "web", 1.0, 0),
                                 (3, d("2024-03-01"), None, 1, "web", 1.0, 0)],
                                "transaction_id long, transaction_date date, customer_id long, store_id long, "
                                "channel string, total_amount_cad double, is_loyalty_transaction int")
    cust = spark.createDataFrame([(1, "a", "Gold", d("2022-05-01")), (2, "b", "Gold", None), (3, "c", None, None)],
                                 "customer_id long, customer_business_key string, loyalty_tier string, enrollment_date date")
    star = Star({"fact_sales_transaction": txn, "dim_customer": cust}, FX.FACT_DATES, FX.FACT_KEYS, FX.ATTRS, FX.HOPS)
    names = ["loyalty_members", "active_customers"]
    assert {tuple(r) for r in X.over_months(star, names, ["loyalty_tier"], "year").collect()} == {
        ("Gold", 2022, 2, 1), ("Gold", 2023, 2, None), ("Gold", 2024, 2, 1),
        (None, 2022, 1, None), (None, 2023, 1, None), (None, 2024, 1, 0)}
    months = X.over_months(star, ["loyalty_members"], [], "month").collect()
    assert len(months) == 23 and {r.loyalty_members for r in months} == {3}
    gold = Where(("loyalty_tier",), F.col("loyalty_tier") == "Gold")
    assert {tuple(r) for r in X.over_months(star, names, [], "year", gold).collect()} == {
        (2022, 2, 1), (2023, 2, None), (2024, 2, 1)}
    none = star.with_table("fact_sales_transaction", txn.limit(0))
    assert X.over_months(none, names, ["loyalty_tier"], "year").count() == 0
