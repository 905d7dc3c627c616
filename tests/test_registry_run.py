"""The registry-driven run: watermarks, audit, a failing table, the next run."""

import tempfile

import pytest
from pyspark.sql import functions as F

from strata.plans.registry_run import Plan, next_day, run_registry
from strata.sources import control as C
from tests.conftest import rows

REG = [("dim_shop", "dim", ["shop_id"], False, [], 1), ("dim_item", "dim", ["sku"], True, ["price"], 2),
       ("fact_sale", "fact", ["sale_id"], False, [], 20)]
SALES = [(1, 1, "2024-01-01", 5), (2, 2, "2024-01-01", 0), (3, 1, "2024-01-02", 7), (1, 1, "2024-01-02", 6),
         (4, 2, "2024-01-03", 1)]


@pytest.fixture
def lake(spark):
    broken = set()

    def source(name, day):
        if name in broken:
            raise OSError(f"{name} is away")
        if name == "dim_shop":
            return spark.createDataFrame([(1, " one "), (2, "two")], "shop_id long, shop string")
        if name == "dim_item":
            return spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "item_id long, sku string, price double")
        if name == "dim_changes":
            if day != "2024-01-02":
                return None
            return spark.createDataFrame([("dim_item", "a", "price", "10", "12"), ("other", "a", "price", "1", "2")],
                                         "table_name string, business_key string, attribute string, old_value string, "
                                         "new_value string")
        df = spark.createDataFrame(SALES, "sale_id long, item_id long, day string, quantity int")
        df = df.where(F.col("day") == (day or "2024-01-01"))
        return df.withColumn("date", F.col("day").cast("date")).withColumn("month", F.substring("day", 1, 7)).drop("day")

    plan = Plan(tempfile.mkdtemp(prefix="strata-registry-"), source,
                rules={"fact_sale": {"zero_quantity": "quantity = 0 OR quantity IS NULL"}},
                partitions={"fact_sale": "month"}, versions={"fact_sale": [("item", "dim_item", "item_id", "date")]}, buckets=2)
    return plan, broken, spark.createDataFrame(REG, C.REGISTRY_SCHEMA)


def marks(run):
    return {r.table_name: str(r.last_processing_date) for r in run.watermarks().collect()}


def failed(run):
    return {(r.table_name, r.layer) for r in run.audit_table().where("status = 'FAILED'").collect()}


def test_bulk_and_days(spark, lake):
    plan, _, reg = lake
    run = run_registry(spark, plan, reg, "bulk", "2024-01-01")
    assert next_day(run, "2024-01-02", "2024-01-03", "fact_sale") == "2024-01-02"
    for day in ("2024-01-02", "2024-01-02", "2024-01-03"):  # a day twice changes nothing
        run.run("daily", day)
    assert next_day(run, "2024-01-02", "2024-01-03", "fact_sale") is None
    assert marks(run) == {"dim_shop": "2024-01-01", "dim_item": "2024-01-02", "fact_sale": "2024-01-03"}
    v = run.read("gold", "dim_item").select("item_sk", F.col("effective_from").alias("since"), "price")
    got = run.read("gold", "fact_sale").join(v, "item_sk", "left").select("sale_id", "quantity", F.col("since").cast("string"))
    assert rows(got) == [(1, 6, "2024-01-02"), (3, 7, "2024-01-02"), (4, 1, "1900-01-01")]
    assert rows(run.read("gold", "dim_shop"), ["shop", "shop_sk"]) == [("one", 1), ("two", 2)]
    bad = spark.read.parquet(f"{plan.base}/quarantine/fact_sale").where("dq_reasons is not null")
    assert [(r.sale_id, r.dq_reasons, r._quarantined_at is not None) for r in bad.collect()] == [(2, ["zero_quantity"], True)]
    told = {(r.layer, r.table_name, r.message) for r in run.audit_table().collect()}
    assert ("bronze", "fact_sale", "ins=1 upd=1") in told and ("silver", "dim_item", "scd2 ins=1 closed=1") in told
    assert not failed(run)


def test_a_failing_table_stays_alone_and_is_taken_up_later(spark, lake, monkeypatch):
    plan, broken, reg = lake
    broken.add("dim_shop")
    run = run_registry(spark, plan, reg, "bulk", "2024-01-01")
    assert failed(run) == {("dim_shop", "landing")}
    assert marks(run) == {"dim_item": "2024-01-01", "fact_sale": "2024-01-01"}
    upsert = type(run)._upsert
    with monkeypatch.context() as m:  # the fact is lost between silver and gold

        def gold_lost(self, layer, *a, **k):
            if layer == "gold":
                raise OSError("executor lost")
            return upsert(self, layer, *a, **k)

        m.setattr(type(run), "_upsert", gold_lost)
        run.run("daily", "2024-01-02")
    assert {("fact_sale", "all"), ("dim_item", "all")} <= failed(run)
    assert marks(run) == {"dim_item": "2024-01-01", "fact_sale": "2024-01-01"}
    broken.clear()
    run.run("bulk", "2024-01-01")
    run.run("daily", "2024-01-03")
    assert marks(run) == {"dim_shop": "2024-01-01", "dim_item": "2024-01-02", "fact_sale": "2024-01-03"}
    assert rows(run.read("gold", "fact_sale"), ["sale_id", "quantity"]) == [(1, 6), (3, 7), (4, 1)]
    assert run.read("gold", "dim_item").where("is_current").count() == 2
    with pytest.raises(ValueError):
        run.run("weekly", "2024-01-01")
