"""Daily folder pick-up as a restartable file stream.

Each landed file is read once: the file source records what it has seen in
the query checkpoint, so a restart resumes where it stopped (this replaces a
stored high-water date). Every micro-batch is de-duplicated per key and
upserted into the published table; each epoch writes its rows into a folder
named after the epoch, so replaying an epoch after a failure rewrites the same
folder (idempotent), and a commit row is appended only after the folder is
written. What is written grows with the landed rows, not with their number of
files times the table. For large tables that are read often, ``stream_upsert_partitioned`` instead
rewrites only the partitions a micro-batch touches.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import column_list
from strata.operators.merge import dedup_latest
from strata.sources.landing import path_missing, upsert_partitions


class VersionedTable:
    """A table published as ``data/epoch=N`` folders plus a commit log.

    An epoch holds the whole table (``commit``) or, after ``upsert``, the rows that
    it brought, one per key: a micro-batch writes its own rows and never the table
    again. ``current`` reads the last whole epoch with those after it and keeps the
    newest row of each key.
    """

    LOG = "epoch long, keys array<string>, schema string"

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self.commits = os.path.join(base, "_commits")

    def _log(self) -> list[Row]:
        """The commits from the last whole epoch on, in order; one short row per epoch."""
        try:
            log = self.spark.read.schema(self.LOG).parquet(self.commits).distinct().orderBy("epoch").collect()
        except AnalysisException as exc:  # no commit yet; any other failure must not look like an empty table
            if not path_missing(exc):
                raise
            return []
        whole = [i for i, row in enumerate(log) if row.keys is None]
        return log[whole[-1]:] if whole else log

    def _path(self, epoch: int) -> str:
        return os.path.join(self.base, "data", f"epoch={epoch}")

    def current(self) -> DataFrame | None:
        log = self._log()
        if not log:
            return None
        if log[-1].keys is None:
            return self.spark.read.parquet(self._path(log[-1].epoch))
        schema, keys = StructType.fromJson(json.loads(log[-1].schema)), log[-1].keys
        read = self.spark.read.schema(schema).parquet(*[self._path(r.epoch) for r in log])
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/epoch=(-?\d+)/[^/]*$", 1).cast("long")
        rows = read.select(*schema.names, number.alias("__epoch"))
        # A NULL key matches nothing: such rows of several epochs stand side by side.
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        rows = rows.withColumn("__own", F.when(no_key, F.col("__epoch")))
        return dedup_latest(rows, [*keys, "__own"], "__epoch").select(*schema.names)

    def _commit(self, epoch: int, keys: list[str] | None, schema: StructType) -> None:
        self.spark.createDataFrame([(int(epoch), keys, schema.json())], self.LOG).write.mode("append").parquet(self.commits)

    def commit(self, df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(self._path(epoch))
        self._commit(epoch, None, df.schema)

    def upsert(self, batch: DataFrame, keys, epoch: int, order_by: list[str] | str | None = None) -> None:
        """Take over the batch's newest row per key, in every column; columns that
        the table has and the batch has not become NULL, new ones are added."""
        keys = column_list(keys)
        rows, before = dedup_latest(batch, keys, order_by or []), [r for r in self._log() if r.epoch < epoch]
        schema = rows.schema
        if before:
            old = StructType.fromJson(json.loads(before[-1].schema))
            schema = StructType([*old.fields, *(f for f in schema.fields if f.name not in old.names)])
        there = set(rows.columns)
        rows = rows.select(*[(F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in schema.fields])
        rows.write.mode("overwrite").parquet(self._path(epoch))
        self._commit(epoch, keys, schema)


def stream_upsert(spark: SparkSession, source_dir: str, schema: StructType | str, target: VersionedTable,
                  keys, checkpoint: str, order_by: str = "Processing_Date", files_per_batch: int | None = None):
    """Run the pick-up until every file present has been processed
    (``availableNow``); returns the finished streaming query."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        target.upsert(batch, keys, epoch_id, order_by=order_by)

    q = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_upsert_partitioned(spark: SparkSession, source_dir: str, schema: StructType | str, target_path: str,
                              keys, part_col: str, checkpoint: str, order_by: str = "Processing_Date",
                              files_per_batch: int | None = None):
    """S01 for large tables: each micro-batch is upserted into a Parquet table
    partitioned by ``part_col`` (a column that never changes for a key, e.g.
    the order month), reading and rewriting only the partitions the batch
    touches. Replaying a batch after a failure repeats an idempotent upsert."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)

    def upsert(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001
        upsert_partitions(spark, target_path, batch, keys, part_col, order_by=order_by)

    q = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
