"""Property checks on generated tables: the change feed of (old -> new),
applied to old by upsert + deletes, gives back new; upsert is idempotent;
de-dup keeps one row per key."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import merge as MG
from tests.conftest import rows

SCHEMA = "k long, a string, v long"
row = st.tuples(st.integers(0, 15), st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-3, 3)))
table = st.lists(row, max_size=12).map(lambda rs: list({r[0]: r for r in rs}.values()))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(old=table, new=table)
def test_change_feed_round_trip(spark, old, new):
    o = spark.createDataFrame(old, SCHEMA)
    n = spark.createDataFrame(new, SCHEMA)
    cf = MG.change_feed(o, n, "k")
    upserts = MG.read_changes(cf).drop("_change_type")
    deletes = cf.where(F.col("_change_type") == "delete").select("k")
    rebuilt = MG.merge_upsert(o, upserts, "k").join(deletes, "k", "left_anti")
    assert rows(rebuilt, ["k", "a", "v"]) == rows(n, ["k", "a", "v"])


@SETTINGS
@given(t=table, s=table)
def test_upsert_idempotent(spark, t, s):
    tt = spark.createDataFrame(t, SCHEMA)
    ss = spark.createDataFrame(s, SCHEMA)
    once = MG.merge_upsert(tt, ss, "k")
    assert rows(MG.merge_upsert(once, ss, "k")) == rows(once)
    assert once.count() == len({r[0] for r in t} | {r[0] for r in s})


@SETTINGS
@given(rs=st.lists(row, max_size=20))
def test_dedup_one_row_per_key(spark, rs):
    df = spark.createDataFrame(rs, SCHEMA)
    out = MG.dedup_latest(df, "k", "v")
    keys = [r[0] for r in out.collect()]
    assert sorted(keys) == sorted({r[0] for r in rs})
