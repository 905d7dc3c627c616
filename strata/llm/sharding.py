"""Operator 4: weighted rendezvous sharding.

Every shard scores a record by -ln(u) / weight, u a uniform hash of the record's
key and the shard's number; the smallest score wins. Scores do not depend on the
other shards, so a further shard takes records only into itself, and shares
follow the weights.

Slots (0, 1, ... in each shard) come from a prefix sum in two levels: records of
a shard are split into ``BUCKETS`` by a hash, bucket counts are summed before the
shuffle, and records are numbered within their bucket. No task orders a shard.

Defined results: null texts are empty; a null key is one value like any other;
rows with a repeated key go to one shard and get a slot each. Further columns do
not matter. Only key, size and checksum are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_of

N_SHARDS, BUCKETS, ROW_BYTES = 40, 1024, 16


def rendezvous(key: Column, weights: list[float], first: int = 0) -> Column:
    """struct(score, shard) of the winner among shards first, first + 1, ..."""
    scored = F.transform(F.array(*[F.lit(float(w)) for w in weights]), lambda w, i: F.struct(
        (-F.log((F.shiftrightunsigned(F.xxhash64(key, i + first, F.lit("shard")), 11) + 0.5) / F.lit(2.0 ** 53)) / w)
        .alias("score"), (i + first).cast("int").alias("shard")))
    return F.array_min(scored)


def assign(docs: DataFrame, n_shards: int = N_SHARDS, weights: list[float] | None = None,
           new_weight: float = 1.0, key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row;
    grown_shard is the shard after one more shard of ``new_weight`` is added."""
    weights = weights or [1.0] * n_shards
    rows = (docs.select(F.col(key).alias("doc_id"), F.octet_length(text_of()).cast("long").alias("bytes"),
                        F.crc32(text_of()).cast("long").alias("text_crc32"))
            .withColumn("now", rendezvous(F.col("doc_id"), weights))
            .withColumn("more", rendezvous(F.col("doc_id"), [new_weight], n_shards)))
    placed = materialise(rows.select(
        "doc_id", (F.col("bytes") + ROW_BYTES).alias("size"), "text_crc32", F.col("now.shard").alias("shard"),
        F.when(F.col("more.score") < F.col("now.score"), F.col("more.shard")).otherwise(F.col("now.shard"))
        .alias("grown_shard"),
        F.expr(f"cast(pmod(xxhash64(doc_id, text_crc32, bytes), {BUCKETS}) as int)").alias("bucket")), "shards")
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("row", F.row_number().over(within)).join(starts, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("row") - 1).cast("long").alias("slot"), "grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, weights: list[float] | None = None,
                 key: str = "doc_id") -> None:
    """Write the rows in one folder per shard (column ``_shard``); a shard's rows
    are spread over ``BUCKETS`` tasks at most, not gathered in one."""
    shard = rendezvous(F.col(key), weights or [1.0] * n_shards)["shard"]
    (docs.withColumn("_shard", shard)
     .repartition("_shard", F.expr(f"pmod(xxhash64(`{key}`), 16)"))
     .write.partitionBy("_shard").parquet(path))
