"""Late dimension images in any order, re-keyed facts, positioned change reads,
and an upsert interrupted at every step."""

import os
import random
import tempfile

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import merge as MG
from strata.sources import changes as CH
from strata.sources.landing import read_partitioned, upsert_partitions
from tests.conftest import rows

IMAGE = "k long, tier string, day date"
COLS = ["k", "tier", "effective_from", "effective_to", "is_current"]


def images(spark, days):
    data = [(k, t, d) for d, image in days for k, t in image.items()]
    return spark.createDataFrame(data, "k long, tier string, day string").withColumn("day", F.col("day").cast("date"))


@pytest.mark.parametrize("seed", range(6))
def test_images_in_any_order_give_the_table_of_the_whole_history(spark, seed):
    r = random.Random(seed)
    days = [(f"2024-01-{d:02d}", {k: r.choice("AB") if r.random() < .9 else None for k in range(5) if r.random() < .8})
            for d in r.sample(range(1, 28), 6)]
    table, seen = None, None
    for n, (day, image) in enumerate(days):
        img = spark.createDataFrame(list(image.items()), "k long, tier string")
        table = \
            spark.createDataFrame(H.apply_image(table, seen, img, "k", ["tier"], day, "day").collect(),
                                  "k long, tier string, scd_hash string, effective_from date, effective_to date, "
                                  "is_current boolean")
        seen = images(spark, days[:n + 1])
    whole = H.scd2_from_history(images(spark, days), "k", ["tier"], "day")
    assert rows(table, COLS) == rows(whole, COLS)
    assert H.intervals_ok(table, "k").count() == 0


def test_resent_image_replaces_that_of_its_date(spark):
    a = [("2024-01-01", {1: "A"}), ("2024-01-05", {1: "B"}), ("2024-01-09", {1: "B"})]
    table = H.scd2_from_history(images(spark, a), "k", ["tier"], "day")
    new = spark.createDataFrame([(1, "A")], "k long, tier string")
    got = H.apply_image(table, images(spark, a), new, "k", ["tier"], "2024-01-05", "day")
    want = H.scd2_from_history(images(spark, [a[0], ("2024-01-05", {1: "A"}), a[2]]), "k", ["tier"], "day")
    assert rows(got, COLS) == rows(want, COLS)


def test_only_rows_in_moved_intervals_are_restated(spark):
    before = [("2024-01-01", {1: "A", 2: "A"}), ("2024-03-01", {1: "B"})]
    after = [*before, ("2024-02-01", {1: "C"})]
    sk = lambda days: H.gold_dim_scd2(
        H.scd2_from_history(images(spark, sorted(days)), "k", ["tier"], "day"), "dim", "k")
    old, new = sk(before), sk(after)
    fact = spark.createDataFrame([(i, 1 + i % 2, f"2024-0{1 + i % 3}-15") for i in range(24)], "id long, k long, d string")
    fact = fact.withColumn("d", F.col("d").cast("date"))
    keyed = H.effective_join(fact, old, "k", "d", "dim")
    want = {r.id: r.dim_sk for r in H.effective_join(fact, new, "k", "d", "dim").collect()}
    was = {r.id: r.dim_sk for r in keyed.collect()}
    got = {r.id: r.dim_sk for r in H.restate_keys(keyed, old, new, "k", "d", "dim").collect()}
    assert got == {i: s for i, s in want.items() if s != was[i]} and got


def test_consumers_read_from_their_own_position(spark):
    base = tempfile.mkdtemp(prefix="strata-changes-")
    reader = CH.ChangeReader(spark, "t", f"{base}/t_changes", f"{base}/control")
    schema = "k long, v string"
    states = [[(1, "a"), (2, "b")], [(1, "a"), (2, "B"), (3, "c")], [(2, "B"), (3, "C")]]
    tables = [spark.createDataFrame(s, schema) for s in states]
    old, mirror = None, None
    for version, now in enumerate(tables):
        for _ in range(2):  # a retried commit replaces its version
            CH.commit_changes(MG.change_feed(old, now, "k"), reader.path, version,
                              F.lit(f"2024-01-0{version + 1} 00:00:00"))
        old = now
        if version == 0:
            got, upto = reader.read("slow", now)  # no position yet: the whole table
            assert rows(got, ["k", "v"]) == states[0]
            reader.advance("slow", upto)
        got, upto = reader.read("quick", now)
        mirror = spark.createDataFrame(CH.apply_changes_to(mirror, got, "k").collect(), schema)
        reader.advance("quick", upto)
        assert rows(mirror) == states[version]
    got, upto = reader.read("slow", tables[2])
    assert upto == 2 and {(r.k, r._change_type, r._commit_version) for r in got.collect()} == {
        (2, "update_postimage", 1), (3, "insert", 1), (1, "delete", 2), (3, "update_postimage", 2)}
    assert rows(CH.apply_changes_to(tables[0], got, "k")) == states[2]
    assert reader.read("quick", tables[2])[0].count() == 0
    assert rows(CH.changes_between(reader.changes(), since="2024-01-03 00:00:00"), ["k", "v"]) == [(3, "C")]
    plan = CH.changes_between(reader.changes(), 1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_commit_version" in plan


def test_consumer_behind_the_kept_versions_reads_in_full(spark):
    base = tempfile.mkdtemp(prefix="strata-changes-")
    reader = CH.ChangeReader(spark, "t", f"{base}/t_changes", f"{base}/control")
    now = spark.createDataFrame([(1, "z")], "k long, v string")
    CH.commit_changes(MG.change_feed(None, now, "k"), reader.path, 7)
    reader.advance("late", 3)
    got, upto = reader.read("late", now)
    assert upto == 7 and rows(got, ["k", "v", "_change_type"]) == [(1, "z", "insert")]


def test_upsert_interrupted_at_every_step_and_run_again(spark, monkeypatch):
    schema = "k long, v string, part string"
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], schema)
    batch = spark.createDataFrame([(1, "a2", "y"), (4, "d", "w"), (3, "c2", "y")], schema)
    want = [(1, "a2", "y"), (2, "b", "y"), (3, "c2", "y"), (4, "d", "w")]
    write = DataFrameWriter.parquet
    for step in range(8):
        path = os.path.join(tempfile.mkdtemp(prefix="strata-retry-"), "t")
        upsert_partitions(spark, path, first, "k", "part")
        left = [step]

        def failing(self, *a, left=left, **k):
            if left[0] == 0:
                raise RuntimeError("lost")
            left[0] -= 1
            return write(self, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", failing)
            try:
                upsert_partitions(spark, path, batch, "k", "part")
                done = True
            except RuntimeError:
                done = False
        upsert_partitions(spark, path, batch, "k", "part")
        assert rows(read_partitioned(spark, path), ["k", "v", "part"]) == want, step
        if done:
            break
    assert step >= 4
