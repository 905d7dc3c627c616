"""Watermark, registry, calendar and the restartable stream pick-up."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from strata.sources import control as C
from strata.sources.calendar import calendar
from strata.streaming.ingest import VersionedTable, stream_upsert
from tests.conftest import rows

d = dt.date.fromisoformat


def test_seed_never_clobbers(spark):
    existing = spark.createDataFrame([("dim_store", "2024-05-01", None, 7)], C.WATERMARK_SCHEMA)
    out = C.seed_watermarks(existing, C.registry(spark))
    got = {r["table_name"]: r["last_processing_date"] for r in out.collect()}
    assert got["dim_store"] == "2024-05-01" and got["dim_banner"] == C.LOW_WATERMARK and len(got) == 12


def test_read_watermark_default(spark):
    assert C.read_watermark(None, "x") == C.LOW_WATERMARK
    wm = spark.createDataFrame([("t", "2024-01-02", None, 1)], C.WATERMARK_SCHEMA)
    assert C.read_watermark(wm, "t") == "2024-01-02"
    assert C.read_watermark(wm, "other") == C.LOW_WATERMARK


def test_next_day_null_when_done(spark):
    w = spark.createDataFrame([(d("2025-12-22"), d("2025-12-31"))], "start date, end date")
    assert C.next_day(w, F.lit(d("2025-12-31"))).collect()[0]["next_day"] is None
    assert C.next_day(w, F.lit(d("2025-12-21"))).collect()[0]["next_day"] == d("2025-12-22")


def test_calendar_flags(spark):
    b = spark.createDataFrame([(d("2024-02-28"), d("2024-03-02"))], "start date, end date")
    cal = {r["date"]: r for r in calendar(b).collect()}
    assert len(cal) == 4 and cal[d("2024-02-29")]["day_of_week_name"] == "Thursday"
    assert cal[d("2024-03-02")]["is_weekend"] == 1 and cal[d("2024-02-29")]["date_id"] == 20240229
    hol = calendar(spark.createDataFrame([(d("2024-07-01"), d("2024-07-01"))], "start date, end date")).collect()[0]
    assert hol["holiday_name"] == "Canada Day" and hol["fiscal_year"] == 2025 and hol["fiscal_quarter"] == "FQ2"


def test_stream_restart_picks_up_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="strata-stream-", dir=spark.sparkContext.getCheckpointDir()
                            .replace("file:", "") if spark.sparkContext.getCheckpointDir() else None)
    src = os.path.join(base, "landing")
    schema = "k long, v string, Processing_Date date"
    spark.createDataFrame([(1, "a", d("2024-01-01")), (2, "b", d("2024-01-01"))], schema) \
        .write.partitionBy("Processing_Date").parquet(src)
    target = VersionedTable(spark, os.path.join(base, "bronze"))
    ck = os.path.join(base, "_ck")
    stream_upsert(spark, src, schema, target, "k", ck)
    assert rows(target.current(), ["k", "v"]) == [(1, "a"), (2, "b")]
    spark.createDataFrame([(2, "b2", d("2024-01-02")), (3, "c", d("2024-01-02"))], schema) \
        .write.mode("append").partitionBy("Processing_Date").parquet(src)
    stream_upsert(spark, src, schema, target, "k", ck)
    assert rows(target.current(), ["k", "v"]) == [(1, "a"), (2, "b2"), (3, "c")]
    # nothing new: a re-run leaves the table as it is
    stream_upsert(spark, src, schema, target, "k", ck)
    assert rows(target.current(), ["k", "v"]) == [(1, "a"), (2, "b2"), (3, "c")]


def test_upsert_partitions_rewrites_only_touched(spark):
    from strata.sources.landing import land, upsert_partitions
    base = tempfile.mkdtemp(prefix="strata-upsert-")
    path = os.path.join(base, "t")
    schema = "k long, v string, dt date"
    upsert_partitions(spark, path, spark.createDataFrame(
        [(1, "a", d("2024-01-01")), (2, "b", d("2024-01-02")), (3, "c", d("2024-01-03"))], schema), "k", "dt")
    untouched = os.path.join(path, "dt=2024-01-01")
    before = sorted(os.listdir(untouched))
    upsert_partitions(spark, path, spark.createDataFrame(
        [(2, "b2", d("2024-01-02")), (4, "d", d("2024-01-04"))], schema), "k", "dt")
    assert rows(spark.read.parquet(path), ["k", "v"]) == [(1, "a"), (2, "b2"), (3, "c"), (4, "d")]
    assert sorted(os.listdir(untouched)) == before
    n = land(spark.createDataFrame([(5, "e")], "k long, v string"), os.path.join(base, "landing"), "2024-01-05")
    assert n == 1


def test_read_source_falls_back_to_csv(spark):
    from strata.sources.tables import read_source
    base = tempfile.mkdtemp(prefix="strata-csv-")
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").write.option("header", True).csv(
        os.path.join(base, "src.csv"))
    df = read_source(spark, os.path.join(base, "src"), "k long, v string")
    assert rows(df) == [(1, "a"), (2, "b")]


def test_absent_change_feed_is_an_empty_batch(spark):
    from strata.sources.landing import land_dim_changes
    out = land_dim_changes(spark, None, "2024-01-01")
    assert out.count() == 0 and "Processing_Date" in out.columns and "new_value" in out.columns


def test_empty_increment_is_a_no_op(spark):
    from strata.plans.medallion import Layers, run_layers
    landed = spark.createDataFrame([], "transaction_id long, customer_id long, transaction_date date, "
                                       "Processing_Date date")
    versions = spark.createDataFrame([], "customer_id long, effective_from date, effective_to date, "
                                         "customer_version_from date")
    st = Layers(watermark="2024-01-01")
    assert run_layers(spark, st, landed, ["transaction_id"], versions, "customer_id", "transaction_date",
                      {}, None, "t") is st


def test_bulk_landing_and_existence_guard(spark):
    from strata.sources.landing import land_all
    from strata.sources.tables import read_if_exists
    base = tempfile.mkdtemp(prefix="strata-bulk-")
    assert read_if_exists(spark, os.path.join(base, "a")) is None
    counts = land_all({"a": spark.createDataFrame([(1,), (2,)], "k long"),
                       "b": spark.createDataFrame([(3,)], "k long")}, base, "2024-01-01",
                      order=[r["table_name"] for r in C.registry(spark).collect()] + ["a", "b"])
    assert counts == {"a": 2, "b": 1}
    assert read_if_exists(spark, os.path.join(base, "a")).count() == 2


def test_partitioned_stream_upsert(spark):
    from strata.streaming.ingest import stream_upsert_partitioned
    base = tempfile.mkdtemp(prefix="strata-pstream-")
    src, tgt, ck = (os.path.join(base, p) for p in ("landing", "bronze", "_ck"))
    schema = "k long, v string, month date, Processing_Date date"
    spark.createDataFrame([(1, "a", d("2024-01-01"), d("2024-02-01")), (2, "b", d("2024-02-01"), d("2024-02-01"))],
                          schema).write.partitionBy("Processing_Date").parquet(src)
    stream_upsert_partitioned(spark, src, schema, tgt, "k", "month", ck)
    spark.createDataFrame([(2, "b2", d("2024-02-01"), d("2024-02-02"))], schema) \
        .write.mode("append").partitionBy("Processing_Date").parquet(src)
    stream_upsert_partitioned(spark, src, schema, tgt, "k", "month", ck)
    assert rows(spark.read.parquet(tgt), ["k", "v"]) == [(1, "a"), (2, "b2")]


def test_rerun_replaces_quarantine_and_landing_batches(spark):
    from strata.operators import quality as DQ
    from strata.sources.landing import land, write_quarantine
    base = tempfile.mkdtemp(prefix="strata-rerun-")
    df = spark.createDataFrame([(1, 0), (2, 5)], "id long, quantity long")
    _, q = DQ.dq_split(df, DQ.RULES["fact_sales_line_item"])
    qpath = os.path.join(base, "quarantine")
    for _ in range(2):  # a re-run of the same batch
        write_quarantine(DQ.quarantine_batch(q, "2024-01-01"), qpath)
    assert spark.read.parquet(qpath).count() == 1
    lpath = os.path.join(base, "landing")
    assert land(df, lpath, "2024-01-01") == 2
    assert land(df, lpath, "2024-01-01") == 2  # re-landing the date replaces it
    assert spark.read.parquet(lpath).count() == 2
    assert land(df.where("id < 0"), lpath, "2024-01-02") == 0  # an empty batch writes nothing
    assert spark.read.parquet(lpath).count() == 2
