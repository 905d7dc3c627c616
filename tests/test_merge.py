"""Upsert, de-dup and change capture on literal edge rows."""

from pyspark.sql import functions as F

from strata.operators import merge as MG
from tests.conftest import rows

SCHEMA = "k long, a string, v double"


def test_upsert_source_null_overwrites(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    s = spark.createDataFrame([(2, "y2", None), (3, "z", 3.0)], SCHEMA)
    out = MG.merge_upsert(t, s, "k")
    assert rows(out) == [(1, "x", 1.0), (2, "y2", None), (3, "z", 3.0)]


def test_upsert_update_cols_keeps_other_columns(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    s = spark.createDataFrame([(1, "changed", 9.0), (4, "new", 4.0)], SCHEMA)
    out = MG.merge_upsert(t, s, "k", update_cols=["v"])
    assert rows(out) == [(1, "x", 9.0), (4, "new", 4.0)]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    s = spark.createDataFrame([(2, "y2", 5.0), (3, "z", 3.0)], SCHEMA)
    once = MG.merge_upsert(t, s, "k")
    twice = MG.merge_upsert(once, s, "k")
    assert rows(once) == rows(twice)


def test_key_twice_in_batch_latest_wins(spark):
    s = spark.createDataFrame([(1, "old", 1.0, "2024-01-01"), (1, "new", 2.0, "2024-01-02"),
                               (2, "only", 3.0, "2024-01-01")], SCHEMA + ", d string")
    out = MG.merge_upsert(None, s, "k", order_by="d")
    assert rows(out, ["k", "a"]) == [(1, "new"), (2, "only")]


def test_dedup_ties_are_deterministic(spark):
    s = spark.createDataFrame([(1, "b", 1.0), (1, "a", 1.0), (1, "c", 0.0)], SCHEMA)
    out = MG.dedup_latest(s, "k", "v")
    # equal order value -> the greater remaining row wins ('b' over 'a')
    assert rows(out) == [(1, "b", 1.0)]


def test_schema_evolution_adds_column(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    s = spark.createDataFrame([(2, "y", 2.0, "extra")], SCHEMA + ", e string")
    out = MG.merge_upsert(t, s, "k")
    assert out.columns == ["k", "a", "v", "e"]
    assert rows(out) == [(1, "x", 1.0, None), (2, "y", 2.0, "extra")]


def test_change_feed_all_types(spark):
    old = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "z", None)], SCHEMA)
    new = spark.createDataFrame([(1, "x", 1.0), (2, "y", 5.0), (3, "z", None), (4, "n", 4.0)], SCHEMA)
    new = new.where(F.col("k") != 1).unionByName(spark.createDataFrame([], SCHEMA))
    cf = MG.change_feed(old, new, "k")
    got = rows(cf, ["k", "_change_type", "v"])
    assert got == sorted([(1, "delete", 1.0), (2, "update_preimage", 2.0), (2, "update_postimage", 5.0),
                          (4, "insert", 4.0)], key=repr)
    # read_changes keeps inserts and post-images only
    rc = MG.read_changes(cf)
    assert rows(rc, ["k", "_change_type"]) == [(2, "update_postimage"), (4, "insert")]


def test_merge_metrics(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], SCHEMA)
    s = spark.createDataFrame([(2, "y2", 5.0), (3, "z", 3.0), (3, "z", 3.0)], SCHEMA)
    m = MG.merge_metrics(t, s, "k").collect()[0]
    assert (m["inserted"], m["updated"]) == (1, 1)


def test_null_keys_bypass_the_join(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (None, "n1", 2.0)], SCHEMA)
    s = spark.createDataFrame([(1, "x2", 1.5), (None, "n2", 3.0)], SCHEMA)
    out = MG.merge_upsert(t, s, "k")
    assert rows(out) == sorted([(1, "x2", 1.5), (None, "n1", 2.0), (None, "n2", 3.0)], key=repr)
    cf = MG.change_feed(t, s, "k")
    assert rows(cf, ["k", "a", "_change_type"]) == sorted(
        [(1, "x", "update_preimage"), (1, "x2", "update_postimage"), (None, "n1", "delete"),
         (None, "n2", "insert")], key=repr)


def test_change_feed_first_version_is_all_inserts(spark):
    new = spark.createDataFrame([(1, "x", 1.0), (None, "n", 2.0)], SCHEMA)
    cf = MG.change_feed(None, new, "k")
    assert rows(cf, ["k", "_change_type"]) == sorted([(1, "insert"), (None, "insert")], key=repr)
