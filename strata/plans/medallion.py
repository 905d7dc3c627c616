"""Layered run: landing -> bronze -> silver -> gold (B09, with C05, D10, E02).

Plain functions in one Spark application; each layer's output is published
as a new version folder (``strata.sources.landing.publish``), which is the
commit point and also cuts the lineage between layers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import merge as MG
from strata.operators import quality as DQ
from strata.session import checkpoint_dir
from strata.sources.landing import new_since, publish, replace_batch, upsert_partitions


@dataclass
class Layers:
    bronze: DataFrame | None = None
    silver: DataFrame | None = None
    gold: DataFrame | None = None
    watermark: str = "1900-01-01"


def run_layers(spark: SparkSession, state: Layers, landed: DataFrame, keys: list[str], versions: DataFrame,
               fact_key: str, date_col: str, rules: dict[str, str], base: str | None = None,
               name: str = "fact") -> Layers:
    """Process every landing partition newer than the state's watermark
    through all layers and return the next state."""
    batch = new_since(landed, state.watermark)
    wm = batch.agg(F.max("Processing_Date").cast("string").alias("m")).head()["m"]
    if wm is None:  # nothing new: an empty increment is a no-op
        return state
    # bronze: latest row per key, upsert
    latest = publish(MG.dedup_latest(batch, keys, "Processing_Date"), f"batch_{name}", base, spark)
    bronze = publish(MG.merge_upsert(state.bronze, latest, keys, assume_unique=True), f"bronze_{name}", base, spark)
    # silver: the batch's rows -> cleanse -> quality split -> upsert, bad rows kept with their reasons
    clean, bad = DQ.dq_split(DQ.cleanse(latest), rules)
    replace_batch(DQ.quarantine_batch(bad, wm), f"{base or checkpoint_dir(spark)}/quarantine_{name}", "_batch", wm)
    silver = publish(MG.merge_upsert(state.silver, clean, keys), f"silver_{name}", base, spark)
    # gold: resolve the dimension version in force on the fact date, upsert changed rows
    silver_changes = MG.read_changes(MG.change_feed(state.silver, silver, keys)).drop("_change_type")
    # Every increment meets all versions: sort-merged, they never pass through the driver.
    g = H.effective_join(silver_changes, versions.hint("merge"), fact_key, date_col, "customer",
                         carry=["customer_version_from"])
    gold = publish(MG.merge_upsert(state.gold, g, keys), f"gold_{name}", base, spark)
    return Layers(bronze, silver, gold, wm)


def run_layers_partitioned(spark: SparkSession, base: str, watermark: str, landed: DataFrame, keys: list[str],
                           part_col: str, versions: DataFrame, fact_key: str, date_col: str,
                           rules: dict[str, str], name: str = "fact", keys_stay: bool = False) -> str:
    """B09 for large tables: the same layers, each a Parquet table partitioned
    by ``part_col`` (``keys_stay``: never changes for a key). Every layer reads, merges and rewrites
    only the partitions the increment touches, and hands only its change rows
    to the next layer. Returns the new watermark."""
    batch = new_since(landed, watermark)
    wm = batch.agg(F.max("Processing_Date").cast("string").alias("m")).head()["m"]
    if wm is None:
        return watermark
    path = lambda layer: f"{base}/{layer}_{name}"
    # Each layer is fed the batch itself: after a failure between layers, the
    # next run starts from the old watermark and carries the batch through again.
    bronze_changes = upsert_partitions(spark, path("bronze"), batch, keys, part_col, order_by="Processing_Date",
                                       with_changes=True, keys_stay=keys_stay)
    clean, bad = DQ.dq_split(DQ.cleanse(bronze_changes), rules)
    replace_batch(DQ.quarantine_batch(bad, wm), path("quarantine"), "_batch", wm)
    silver = {}
    silver_changes = upsert_partitions(spark, path("silver"), clean, keys, part_col, with_changes=True, keys_stay=keys_stay,
                                       metrics=silver, unique=DQ.keeps(clean, keys), rebalance=False)
    if silver["inserted"] + silver["updated"] == 0:
        return wm
    # Every increment meets all versions: sort-merged, they never pass through the driver.
    g = H.effective_join(silver_changes, versions.hint("merge"), fact_key, date_col, "customer",
                         carry=["customer_version_from"])
    upsert_partitions(spark, path("gold"), g, keys, part_col, keys_stay=keys_stay, some=True)
    return wm
