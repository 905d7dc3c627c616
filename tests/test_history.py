"""SCD2 properties and the effective-date join on literal and fixture rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import history as H
from strata.sources import fixtures as FX
from strata.sources.tables import read_table
from tests.conftest import SF01, rows


def d(s):
    return dt.date.fromisoformat(s)


def test_same_date_change_replaces_version(spark):
    img1 = spark.createDataFrame([(1, "A")], "k long, tier string")
    img2 = spark.createDataFrame([(1, "B")], "k long, tier string")
    t = H.apply_scd2(None, img1, "k", ["tier"], "2024-01-01")
    t = H.apply_scd2(t, img2, "k", ["tier"], "2024-01-01")
    got = rows(t, ["k", "tier", "effective_from", "effective_to", "is_current"])
    assert got == [(1, "B", d("2024-01-01"), d("9999-12-31"), True)]


def test_apply_closes_and_inserts(spark):
    img1 = spark.createDataFrame([(1, "A"), (2, "A")], "k long, tier string")
    img2 = spark.createDataFrame([(1, "B"), (2, "A"), (3, "C")], "k long, tier string")
    t = H.apply_scd2(H.apply_scd2(None, img1, "k", ["tier"], "2024-01-01"), img2, "k", ["tier"], "2024-02-01")
    got = rows(t, ["k", "tier", "effective_from", "effective_to", "is_current"])
    assert got == sorted([
        (1, "A", d("2024-01-01"), d("2024-02-01"), False), (1, "B", d("2024-02-01"), d("9999-12-31"), True),
        (2, "A", d("2024-01-01"), d("9999-12-31"), True), (3, "C", d("2024-02-01"), d("9999-12-31"), True)],
        key=repr)
    assert H.intervals_ok(t, "k").count() == 0


def test_from_history_equals_iterated_apply(spark):
    cy = FX.customer_year(read_table(spark, SF01, "orders")).select("customer_id", "loyalty_tier", "image_date", "yr")
    bulk = H.scd2_from_history(cy.drop("yr"), "customer_id", ["loyalty_tier"], "image_date")
    t = None
    for (yr,) in sorted(cy.select("yr").distinct().collect()):
        img = cy.where(F.col("yr") == yr).select("customer_id", "loyalty_tier")
        t = H.apply_scd2(t, img, "customer_id", ["loyalty_tier"], f"{yr}-01-01")
        t = t.checkpoint()
    cols = ["customer_id", "loyalty_tier", "scd_hash", "effective_from", "effective_to", "is_current"]
    assert rows(bulk, cols) == rows(t, cols)
    assert H.intervals_ok(bulk, "customer_id").count() == 0


def test_effective_join_boundaries_and_row_count(spark):
    versions = spark.createDataFrame(
        [(1, d("2024-01-01"), d("2024-03-01"), 11), (1, d("2024-03-01"), d("9999-12-31"), 12)],
        "id long, effective_from date, effective_to date, x_sk long")
    fact = spark.createDataFrame(
        [(1, d("2024-01-01")), (1, d("2024-02-29")), (1, d("2024-03-01")), (None, d("2024-03-05")),
         (2, d("2024-03-05")), (1, d("2023-12-31"))], "id long, dt date")
    out = H.effective_join(fact, versions, "id", "dt", "x")
    assert out.count() == fact.count()
    got = rows(out, ["id", "dt", "x_sk"])
    assert got == sorted([(1, d("2024-01-01"), 11), (1, d("2024-02-29"), 11), (1, d("2024-03-01"), 12),
                          (None, d("2024-03-05"), None), (2, d("2024-03-05"), None),
                          (1, d("2023-12-31"), None)], key=repr)


def test_surrogate_key_stable_and_unique(spark):
    v = spark.createDataFrame([("a", d("2024-01-01")), ("a", d("2024-02-01")), ("b", d("2024-01-01"))],
                              "bk string, effective_from date")
    k1 = rows(v.select(H.surrogate_key("bk", "effective_from").alias("sk")))
    k2 = rows(v.select(H.surrogate_key("bk", "effective_from").alias("sk")))
    assert k1 == k2 and len(set(k1)) == 3
