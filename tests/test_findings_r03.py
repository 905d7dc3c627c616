"""Round 3: queries build only what they read, versions stay off the driver, an
upsert writes its rows once."""

import os
import tempfile

from pyspark.sql import functions as F

from strata.operators import history as H
from strata.plans import medallion
from strata.plans.star import LazyTables, Star
from strata.sources import fixtures as FX
from strata.sources.landing import read_partitioned, upsert_partitions
from strata.streaming.ingest import VersionedTable
from tests.conftest import SF001, rows


def scratch(name):
    return tempfile.mkdtemp(prefix=f"strata-{name}-")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_query_builds_only_the_star_tables_it_reads(spark):
    FX._PUBLISHED.pop((spark.sparkContext.applicationId, SF001), None)
    star = FX.retail_star(spark, SF001)
    star.table("dim_banner").count()
    assert set(star.tables.made) == {"dim_banner"}
    star.calendar().count()
    assert set(star.tables.made) == {"dim_banner", "dim_date", "fact_sales_line_item"}
    ends = FX.calendar_of([star.table(f).select(F.col(d).alias("date")) for f, d in FX.FACT_DATES.items()
                           if f.startswith("fact_")])
    assert rows(star.calendar()) == rows(ends)


def test_a_replaced_table_builds_no_other(spark):
    made = []
    one = lambda name: lambda: made.append(name) or spark.range(3).withColumnRenamed("id", "k")
    star = Star(LazyTables({n: one(n) for n in ("a", "b")}), {}, {}, {})
    other = star.with_table("a", spark.range(1))
    assert other.table("a").count() == 1 and "b" in other.tables and made == []
    assert other.table("b").count() == 3 and made == ["b"] and star.table("b").count() == 3 and made == ["b"]


def versions_file(spark):
    path = os.path.join(scratch("versions"), "v")
    spark.sql("""SELECT id AS k, id AS customer_id, DATE'2000-01-01' AS effective_from, DATE'9999-12-31' AS effective_to,
        true AS is_current, 'x' AS tier, sha2('x', 256) AS scd_hash, id AS dim_sk,
        DATE'2000-01-01' AS customer_version_from FROM range(5)""").write.parquet(path)
    return spark.read.parquet(path)


def test_versions_are_not_broadcast(spark):
    v = versions_file(spark)
    image = v.select("k", "tier").withColumn("tier", F.lit("y"))
    held = v.select("k", "tier", "scd_hash", "effective_from", "effective_to", "is_current")
    images = v.select("k", "tier").withColumn("day", F.lit("2001-01-01").cast("date"))
    fact = spark.sql("SELECT id, id AS k, id AS dim_sk, DATE'2020-01-01' AS d FROM range(9)")
    for df in (H.apply_scd2(held, image, "k", ["tier"], "2010-01-01"),
               H.apply_image(held, images, image, "k", ["tier"], "2010-01-01", "day"),
               H.restate_keys(fact, v.where("k > 2"), v, "k", "d", "dim")):
        assert "SortMergeJoin" in plan_of(df) and "BroadcastHashJoin" not in plan_of(df)


def test_increments_do_not_broadcast_versions(spark, monkeypatch):
    v, plans, join = versions_file(spark), [], H.effective_join
    monkeypatch.setattr(medallion.H, "effective_join", lambda *a, **k: plans.append(join(*a, **k)) or plans[-1])
    landed = spark.sql("""SELECT id AS transaction_id, id % 5 AS customer_id, DATE'2024-01-05' AS transaction_date, '01' AS month,
        double(id) AS amount, DATE'2024-01-01' AS Processing_Date FROM range(9)""")
    medallion.run_layers(spark, medallion.Layers(), landed, ["transaction_id"], v, "customer_id", "transaction_date",
                         {"no_amount": "amount IS NULL"}, scratch("daily"), "t")
    medallion.run_layers_partitioned(spark, scratch("part"), "1900-01-01", landed, ["transaction_id"], "month", v,
                                     "customer_id", "transaction_date", {"no_amount": "amount IS NULL"}, "t")
    assert len(plans) == 2 and not any("BroadcastHashJoin" in plan_of(p) for p in plans)


def files(path):
    return [f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "_schema" not in d]


def test_the_first_batch_is_written_once(spark):
    path, staging, m = os.path.join(scratch("first"), "t"), scratch("staging"), {}
    batch = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (None, "n", None), (2, "c", "y")], "k long, v string, p string")
    held = upsert_partitions(spark, path, batch, "k", "p", order_by="v", staging=staging, with_changes=True, metrics=m)
    want = [(1, "b", "x"), (2, "c", "y"), (None, "n", None)]
    assert rows(held) == rows(read_partitioned(spark, path), ["k", "v", "p"]) == want and m == {"inserted": 3, "updated": 0}
    assert files(staging) == []
    # an empty first batch makes no table
    none = os.path.join(scratch("none"), "t")
    upsert_partitions(spark, none, batch.where("k > 9"), "k", "p", metrics=m)
    assert read_partitioned(spark, none) is None and m == {"inserted": 0, "updated": 0}


def test_overlapping_versions_are_found(spark):
    schema = "k long, effective_from string, effective_to string"
    ok = [(1, "2000", "2001"), (1, "2001", "2005"), (2, "2000", "2009"), (None, "2000", "2009"), (None, "2000", "2009")]
    assert H.one_at_a_time(spark.createDataFrame(ok, schema), "k")
    assert not H.one_at_a_time(spark.createDataFrame([*ok, (2, "2003", "2004")], schema), "k")


def test_a_micro_batch_writes_its_own_rows_only(spark):
    base = scratch("stream")
    t = VersionedTable(spark, base)
    t.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "n", 1)], "k long, v string, o int"), "k", 0, "o")
    t.upsert(spark.createDataFrame([(2, "d", None), (None, "m", 2)], "k long, v string, extra int"), "k", 1)
    t.upsert(spark.createDataFrame([(3, "e", 5)], "k long, v string, o int"), "k", 2)
    t.upsert(spark.createDataFrame([(3, "f", 6)], "k long, v string, o int"), "k", 2)  # the epoch once more
    assert spark.read.parquet(os.path.join(base, "data", "epoch=1")).count() == 2
    assert t.current().columns == ["k", "v", "o", "extra"]
    assert rows(t.current()) == [(1, "b", 2, None), (2, "d", None, None), (3, "f", 6, None), (None, "m", None, 2),
                                 (None, "n", 1, None)]
    t.commit(t.current().where("k = 1"), 3)
    assert rows(t.current(), ["k", "v"]) == [(1, "b")]
    t.upsert(spark.createDataFrame([(1, "z", 9)], "k long, v string, o int"), "k", 4)
    assert rows(t.current(), ["k", "v"]) == [(1, "z")]
