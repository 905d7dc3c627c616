"""The partition-scoped upsert and layered run in the situations that lost or
doubled rows: new columns, NULL and string partitions, moved keys, empty and
repeated batches, a failure between layers."""

import os
import tempfile

import pytest

from strata.operators import merge as MG
from strata.plans import medallion
from strata.sources.landing import read_partitioned, upsert_partitions
from tests.conftest import rows


@pytest.fixture
def table():
    return os.path.join(tempfile.mkdtemp(prefix="strata-part-"), "t")


def put(spark, path, data, schema="k long, v string, part string", **kw):
    return upsert_partitions(spark, path, spark.createDataFrame(data, schema), "k", "part", **kw)


def held(spark, path, cols=("k", "v", "part")):
    return rows(read_partitioned(spark, path), list(cols))


def test_string_and_null_partitions(spark, table):
    put(spark, table, [(1, "a", "007"), (2, "b", None)])
    put(spark, table, [(1, "a2", "007"), (3, "c", None)])
    assert held(spark, table) == [(1, "a2", "007"), (2, "b", None), (3, "c", None)]


def test_moved_key_leaves_its_old_partition(spark, table):
    put(spark, table, [(1, "a", "x"), (2, "b", "y"), (3, "c", "y")])
    put(spark, table, [(1, "a2", "y"), (3, "c2", "z/1")])
    assert held(spark, table) == [(1, "a2", "y"), (2, "b", "y"), (3, "c2", "z/1")]
    put(spark, table, [(3, "c3", "x")])
    assert held(spark, table) == [(1, "a2", "y"), (2, "b", "y"), (3, "c3", "x")]


def test_new_columns_are_kept(spark, table):
    put(spark, table, [(1, "a", "x"), (2, "b", "y")])
    put(spark, table, [(1, "a2", "x", 5)], "k long, v string, part string, extra int")
    put(spark, table, [(4, "d", "y")])
    assert held(spark, table, ("k", "v", "part", "extra")) == [
        (1, "a2", "x", 5), (2, "b", "y", None), (4, "d", "y", None)]


def test_empty_and_repeated_batches(spark, table):
    assert put(spark, table, [], with_changes=True).count() == 0
    assert read_partitioned(spark, table) is None
    for _ in range(2):
        got = put(spark, table, [(1, "a", "x"), (1, "b", "x")], with_changes=True)
        assert rows(got, ["k", "v"]) == [(1, "b")]
    put(spark, table, [])
    assert held(spark, table) == [(1, "b", "x")]


def test_upsert_with_a_repeated_key_keeps_one_row(spark):
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    assert rows(MG.merge_upsert(old, new, "k")) == [(1, "c")]
    assert rows(MG.merge_upsert(None, new, "k")) == [(1, "c")]


def test_change_feed_with_a_new_column(spark):
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 3)], "k long, v string, extra int")
    assert rows(MG.read_changes(MG.change_feed(old, new, "k")), ["k", "v", "extra"]) == [(2, "b", 3)]


def test_layered_run_survives_a_failure_between_layers(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="strata-layers-")
    schema = ("transaction_id long, customer_id long, transaction_date date, amount double, month string, "
              "Processing_Date date")
    landed = spark.sql("""SELECT id AS transaction_id, 1L AS customer_id, DATE'2024-01-05' AS transaction_date,
        IF(id = 3, NULL, double(id)) AS amount, IF(id < 3, '01', '02') AS month,
        IF(id < 3, DATE'2024-01-01', DATE'2024-01-02') AS Processing_Date FROM range(5)""").to(
            spark.createDataFrame([], schema).schema)
    versions = spark.sql("""SELECT 1L AS customer_id, DATE'2000-01-01' AS effective_from,
        DATE'9999-12-31' AS effective_to, DATE'2000-01-01' AS customer_version_from""")

    def run(wm, upto):
        return medallion.run_layers_partitioned(
            spark, base, wm, landed.where(f"Processing_Date <= DATE'{upto}'"), ["transaction_id"], "month", versions,
            "customer_id", "transaction_date", {"no_amount": "amount IS NULL"}, "t")

    with monkeypatch.context() as m:
        m.setattr(medallion.H, "effective_join", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run("1900-01-01", "2024-01-01")
    assert run("1900-01-01", "2024-01-02") == "2024-01-02"
    for layer, want in (("bronze", [0, 1, 2, 3, 4]), ("silver", [0, 1, 2, 4]), ("gold", [0, 1, 2, 4])):
        got = read_partitioned(spark, f"{base}/{layer}_t")
        assert [r[0] for r in rows(got, ["transaction_id"])] == want
    bad = spark.read.parquet(f"{base}/quarantine_t").where("dq_reasons is not null")
    assert rows(bad, ["transaction_id"]) == [(3,)]
