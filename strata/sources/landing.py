"""Landing, incremental scans and table publishing.

Tables are Parquet folders. A landing table is partitioned by
``Processing_Date`` and written with dynamic partition overwrite, so landing
the same date twice replaces that date instead of duplicating it. A table
produced by an upsert is published as a new version folder and read back,
which also cuts the plan's lineage; the folder lives under the cluster's
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.merge import dedup_latest, merge_upsert
from strata.session import checkpoint_dir

# The partition column of landing tables and the schema of the
# attribute-change feed.
PARTITION_COL = "Processing_Date"
DIM_CHANGES_SCHEMA = StructType([StructField(n, StringType()) for n in
                                 ("table_name", "business_key", "attribute", "old_value", "new_value")])


def stamp(df: DataFrame, proc_date: str, landed_at: bool = True) -> DataFrame:
    """Add ``Processing_Date`` (DATE) and, optionally, ``_landed_at``."""
    out = df.withColumn(PARTITION_COL, F.lit(proc_date).cast("date"))
    return out.withColumn("_landed_at", F.current_timestamp()) if landed_at else out


def write_landing(df: DataFrame, path: str) -> None:
    """Append a stamped batch; dynamic overwrite replaces re-landed dates."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION_COL).parquet(path))


def land_daily(df: DataFrame, date_col: str, proc_date: str) -> DataFrame:
    """The rows of one dated increment, stamped with that date."""
    d = F.lit(proc_date).cast("date")
    return stamp(df.where(F.col(date_col).cast("date") == d), proc_date, landed_at=False)


def land_dim_changes(spark: SparkSession, changes: DataFrame | None, proc_date: str) -> DataFrame:
    """The optional change feed of a day; an absent feed is an empty batch."""
    if changes is None:
        changes = spark.createDataFrame([], DIM_CHANGES_SCHEMA)
    return changes.withColumn(PARTITION_COL, F.lit(proc_date).cast("date"))


def new_since(landed: DataFrame, watermark: str) -> DataFrame:
    """Landing partitions newer than the watermark (a partition filter
    on a partitioned table, so only those folders are listed and read)."""
    return landed.where(F.col(PARTITION_COL) > F.lit(watermark).cast("date"))


def landing_to_bronze(bronze: DataFrame | None, landed: DataFrame, keys, watermark: str,
                      order_by: str = PARTITION_COL) -> DataFrame:
    """New partitions -> latest row per key -> upsert into bronze."""
    batch = dedup_latest(new_since(landed, watermark), keys, order_by)
    return merge_upsert(bronze, batch, keys)


def publish(df: DataFrame, name: str, base: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as a new version folder of table ``name`` and read it back.

    The write is the commit: a reader never sees a half-written version, a
    failed task is retried by Spark, and the returned DataFrame starts a new
    lineage from the written files.
    """
    spark = spark or df.sparkSession
    base = base or checkpoint_dir(spark)
    path = os.path.join(base, "tables", name, f"v-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def land(df: DataFrame, path: str, proc_date: str) -> int:
    """Stamp and write one batch; returns the rows written.

    The count comes from an ``Observation`` on the write itself (one pass over
    the data, not a second ``count()`` job); an empty batch writes nothing.
    """
    obs = Observation("landed")
    write_landing(stamp(df, proc_date).observe(obs, F.count(F.lit(1)).alias("rows")), path)
    return int(obs.get.get("rows", 0))


def land_all(sources: dict[str, DataFrame], base: str, proc_date: str,
             order: list[str] | None = None) -> dict[str, int]:
    """Bulk mode - land every registered source under ``base/<name>``,
    in registry load order; one write job per table, row counts observed."""
    names = [n for n in (order or list(sources)) if n in sources]
    return {n: land(sources[n], os.path.join(base, n), proc_date) for n in names}


def write_quarantine(quarantine: DataFrame, path: str) -> None:
    """Quarantine rows by batch; a re-run of a batch replaces its partition."""
    (quarantine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_batch").parquet(path))


def append_rows(df: DataFrame, path: str) -> None:
    """Append (audit rows, commit rows)."""
    df.write.mode("append").parquet(path)


def replace_batch(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace one partition of a table, also by no rows (D08: a re-run of a
    batch without bad rows clears what an earlier run wrote)."""
    df.drop(column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")


def path_missing(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "") == "PATH_NOT_FOUND"


def read_partitioned(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written by ``upsert_partitions``, with the column types it was
    written with (a string partition ``007`` stays a string) and all columns it
    ever had; None when it does not exist yet."""
    try:
        kept = spark.read.parquet(os.path.join(path, "_schema")).head()
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        kept = None
    try:
        reader = spark.read.schema(StructType.fromJson(json.loads(kept[0]))) if kept else \
            spark.read.option("mergeSchema", "true")
        return reader.parquet(path)
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return None


def _swap_in(df: DataFrame, path: str, part_col: str, grown: bool = True, rebalance: bool = True) -> None:
    """Replace the partitions that ``df`` has rows in; a ``grown`` schema goes
    first, so that it always covers the files."""
    spark = df.sparkSession
    if grown:
        spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(path, "_schema"))
    out = df.hint("rebalance", part_col) if rebalance else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)


def replace_partitions(df: DataFrame, path: str, part_col: str, staging: str | None = None,
                       observe: tuple[Observation, list] | None = None) -> DataFrame:
    """Replace the partitions that ``df`` has rows in by its rows, also where it
    was read from the same table: it is staged first. Returns the staged rows."""
    base = staging or os.path.join(checkpoint_dir(df.sparkSession), "staging", f"r-{uuid.uuid4().hex}")
    out = df if observe is None else df.observe(observe[0], *observe[1])
    out.hint("rebalance", part_col).write.mode("overwrite").partitionBy(part_col).parquet(base)
    staged = df.sparkSession.read.schema(df.schema).parquet(base)
    _swap_in(staged, path, part_col)
    return staged


def upsert_partitions(spark: SparkSession, target_path: str, source: DataFrame, keys, part_col: str,
                      order_by: list[str] | str | None = None, staging: str | None = None,
                      with_changes: bool = False, keys_stay: bool = False,
                      metrics: dict | None = None, unique: bool = False, rebalance: bool = True,
                      some: bool = False) -> DataFrame | None:
    """C01 at scale: upsert into a Parquet table partitioned by ``part_col``,
    reading and rewriting only the partitions the batch touches.

    The batch is reduced to one row per key and staged once; the first batch is
    written to the table at once and read back from it. The caller can vouch that
    no key comes twice (``unique``) and that there are rows (``some``), and keep
    rows that were read by partition where they are (``rebalance=False``), which
    saves a shuffle each. Touched are its own
    partitions (NULL included) and those that hold its keys now, found by a scan
    of keys and partition alone; with ``keys_stay`` the caller vouches that a key
    never changes partition and the scan is saved. The target is semi-joined with
    the touched values, so dynamic partition pruning lists and reads only those
    folders. The merged partitions are staged (a path may not be overwritten while
    it is read) and swapped in; a partition that lost its last row is emptied.
    Columns new in the batch are added to the table. An empty batch changes nothing.

    ``metrics`` receives the rows ``inserted`` and ``updated`` (C03), observed on the
    writes themselves. With ``with_changes`` the staged batch is returned, as the table now holds its
    keys: the next layer is fed from it, not from a difference that a retry after
    a failure would find empty. Repeating a batch gives the same table, also after
    a run that failed at any step (NULL keys aside, which match nothing).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    base = staging or os.path.join(checkpoint_dir(spark), "staging", f"u-{uuid.uuid4().hex}")
    metrics = {} if metrics is None else metrics
    metrics.update(inserted=0, updated=0)
    if not some and source.isEmpty():
        return source if with_changes else None
    source = source if unique else dedup_latest(source, keys, order_by or [])
    target = read_partitioned(spark, target_path)
    if target is None:  # first load: the table does not exist yet
        loaded = Observation()
        _swap_in(source.observe(loaded, F.count(F.lit(1)).alias("n")), target_path, part_col, rebalance=rebalance)
        metrics["inserted"] = loaded.get["n"]
        held = spark.read.schema(source.schema).parquet(target_path).select(*source.columns)
        return held if with_changes else None
    source.write.mode("overwrite").parquet(os.path.join(base, "source"))
    source = spark.read.schema(source.schema).parquet(os.path.join(base, "source"))
    n, n_null = source.agg(F.count(F.lit(1)), F.count_if(F.col(part_col).isNull())).first()
    fields = [f for f in target.schema.fields if f.name != part_col]
    known = {f.name for f in fields} | {part_col}
    fields += [f for f in source.schema.fields if f.name not in known]
    schema = StructType(fields + [source.schema[part_col]])
    target = spark.read.schema(schema).parquet(target_path)

    touched = source.select(part_col).distinct()
    if not keys_stay:
        held = target.select(*keys, part_col).join(source.select(*keys), keys, "left_semi").select(part_col)
        touched.unionByName(held).distinct().write.mode("overwrite").parquet(os.path.join(base, "touched"))
        touched = spark.read.schema(touched.schema).parquet(os.path.join(base, "touched"))
        n_null = touched.where(F.col(part_col).isNull()).count()
    affected = target.join(touched.where(F.col(part_col).isNotNull()), part_col, "left_semi")
    if n_null:
        affected = affected.unionByName(target.where(F.col(part_col).isNull()))
    # A row of the batch replaces every target row of its key, so a key that an
    # interrupted run left in two partitions stands once afterwards.
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in source.columns}
    there, stay = Observation(), Observation()
    kept = affected.observe(there, F.count(F.lit(1)).alias("n")).join(source.select(*keys), keys, "left_anti")
    kept = kept.observe(stay, F.count(F.lit(1)).alias("n"))
    merged = kept.select(*schema.names).unionByName(source.withColumns(missing).select(*schema.names))
    # Rows of a partition meet before they are written: few files, large partitions split by their size.
    merged.hint("rebalance", part_col).write.mode("overwrite").partitionBy(part_col).parquet(os.path.join(base, "merged"))
    metrics["updated"] = min(n, there.get["n"] - stay.get["n"])
    metrics["inserted"] = n - metrics["updated"]
    staged = spark.read.schema(schema).parquet(os.path.join(base, "merged"))
    _swap_in(staged, target_path, part_col, grown=len(schema) > len(known))
    if keys_stay:  # no partition can have lost its rows
        return source if with_changes else None
    left = staged.select(F.col(part_col).alias("_p")).distinct()
    emptied = touched.join(left, F.col(part_col).eqNullSafe(F.col("_p")), "left_anti").where(F.col(part_col).isNotNull())
    name_of = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    nothing = staged.drop(part_col).limit(0)
    for row in emptied.select(F.col(part_col).cast("string")).toLocalIterator():
        nothing.write.mode("overwrite").parquet(os.path.join(target_path, name_of(part_col, row[0])))
    return source if with_changes else None
