"""Registry-driven layered run (B02, B04, B05, B09 with C05, D08-D11, E01-E07).

``run_registry`` goes through the registry in load order and takes every table
from its landing partitions to gold. Business keys, tracked attributes and kind of
table come from the registry rows, quality rules and the partition column from
``Plan``. Each table has its own watermark row and audit rows; row counts are
observed on the writes, no table is counted a second time. A table that fails is
audited with its error and leaves its watermark where it was; the others go on,
and the next run takes the failed one up from there.

Tables are Parquet folders under ``base/<layer>/<table>``, partitioned by a column
of theirs or, for tables without one, by a hash of the business key, so every
write touches only the partitions of the rows that came.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import quality as DQ
from strata.sources import control as C
from strata.sources.landing import (PARTITION_COL, append_rows, land, new_since, read_partitioned,
                                    replace_batch, replace_partitions, upsert_partitions)
from strata.sources.tables import read_if_exists

BUCKET = "_bucket"


@dataclass
class Plan:
    """What the registry does not say. ``source(table, date)`` gives the raw rows
    of a table: all of them (bulk, date None) or those of a day; None where there
    are none. ``versions`` lists for a fact (short name, dimension, id column, date
    column) of its historized dimensions."""

    base: str
    source: Callable[[str, str | None], DataFrame | None]
    rules: dict[str, dict[str, str]] = field(default_factory=lambda: dict(DQ.RULES))
    partitions: dict[str, str] = field(default_factory=dict)
    versions: dict[str, list[tuple[str, str, str, str]]] = field(default_factory=dict)
    natural_id: dict[str, str] = field(default_factory=dict)
    first_date: str = C.LOW_WATERMARK
    buckets: int = 8


class RegistryRun:
    """One pass over the registry; state lies under ``plan.base`` alone."""

    def __init__(self, spark: SparkSession, plan: Plan, registry: DataFrame):
        self.spark, self.plan = spark, plan
        self.tables: list[Row] = registry.orderBy("load_order").collect()  # one row per table

    def path(self, layer: str, table: str) -> str:
        return os.path.join(self.plan.base, layer, table)

    def read(self, layer: str, table: str) -> DataFrame | None:
        """A table of a layer, None before its first load."""
        out = read_partitioned(self.spark, self.path(layer, table))
        return out if out is None or BUCKET not in out.columns else out.drop(BUCKET)

    # --- control -----------------------------------------------------------------
    def watermarks(self) -> DataFrame:
        kept = read_if_exists(self.spark, self.path("control", "watermark"))
        return kept if kept is not None else self.spark.createDataFrame([], C.WATERMARK_SCHEMA)

    def watermark(self, table: str) -> str:
        return C.read_watermark(self.watermarks(), table)

    def advance(self, table: str, date: str, rows: int) -> None:
        """The table's own row, in its own partition: no other table's is read or written."""
        row = self.spark.range(1).select(F.lit(date).alias("last_processing_date"),
                                         F.current_timestamp().alias("last_run_timestamp"),
                                         F.lit(rows).cast("long").alias("last_rows_affected"))
        row.write.mode("overwrite").parquet(f"{self.path('control', 'watermark')}/table_name={table}")

    def audit(self, step: str, layer: str, table: str, rows: int, status: str = "OK", message: str = "") -> None:
        """Append one audit row."""
        append_rows(self.spark.range(1).select(
            F.current_timestamp().alias("run_ts"), F.lit(step).alias("notebook"), F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"), F.lit(rows).cast("long").alias("rows_affected"),
            F.lit(status).alias("status"), F.lit(message).alias("message")), self.path("control", "load_audit"))

    def audit_table(self) -> DataFrame:
        kept = read_if_exists(self.spark, self.path("control", "load_audit"))
        return kept if kept is not None else self.spark.createDataFrame([], C.AUDIT_SCHEMA)

    # --- steps ---------------------------------------------------------------------
    def land(self, mode: str, date: str) -> None:
        """Bulk lands every table, daily the facts of the day and the
        attribute changes."""
        names = [t.table_name for t in self.tables if mode == "bulk" or t.table_type == "fact"]
        for name in [*names, *(["dim_changes"] if mode == "daily" else [])]:
            with self._guard(f"landing {date}", "landing", name):
                raw = self.plan.source(name, None if mode == "bulk" else date)
                if raw is not None:
                    n = land(raw, self.path("landing", name), date)
                    self.audit("land", "landing", name, n, message=f"pd={date}")

    def _upsert(self, layer: str, table: str, rows: DataFrame, keys: list[str], order_by=None,
                **known) -> tuple[DataFrame, dict]:
        """C01 by partitions; (the batch as the table now holds it, metrics)."""
        part, metrics = self.plan.partitions.get(table), {}
        if part is None:
            rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(self.plan.buckets)).cast("int"))
        out = upsert_partitions(self.spark, self.path(layer, table), rows, keys, part or BUCKET, order_by=order_by,
                                with_changes=True, keys_stay=part is None, metrics=metrics, **known)
        return out.drop(BUCKET), metrics

    def _split(self, table: str, rows: DataFrame, date: str) -> DataFrame:
        """Clean rows; the others are written with reasons and time."""
        rules = self.plan.rules.get(table)
        if not rules:
            return rows
        clean, bad = DQ.dq_split(rows, rules)
        seen = Observation()
        stamped = DQ.quarantine_batch(bad, date).withColumn("_quarantined_at", F.current_timestamp())
        replace_batch(stamped.observe(seen, F.count(F.lit(1)).alias("n")), self.path("quarantine", table), "_batch", date)
        if seen.get["n"]:
            self.audit("quality", "quarantine", table, seen.get["n"], "QUARANTINE", ",".join(sorted(rules)))
        return clean

    def _told(self, step: str, layer: str, table: str, m: dict) -> None:
        self.audit(step, layer, table, m["inserted"] + m["updated"], message=f"ins={m['inserted']} upd={m['updated']}")

    def _keyed(self, t: Row, batch: DataFrame, date: str) -> int:
        """A fact or a dimension without history: bronze, silver, gold. Each layer
        is fed the batch, so a failure between layers is made good by the next run."""
        name, keys = t.table_name, list(t.business_keys)
        held, m = self._upsert("bronze", name, batch, keys, [PARTITION_COL, "_landed_at"])
        affected = m["inserted"] + m["updated"]
        self._told("bronze", "bronze", name, m)
        clean = self._split(name, DQ.cleanse(held), date)
        # A batch that bronze has made unique stays so, unless trimming makes two keys equal.
        part = self.plan.partitions.get(name)
        held, m = self._upsert("silver", name, clean, keys, unique=DQ.keeps(clean, keys),
                               rebalance=part is None)
        self._told("silver", "silver", name, m)
        unique, some, joined = t.table_type != "dim", m["inserted"] + m["updated"] > 0, False
        if t.table_type == "dim":
            short = name.removeprefix("dim_")
            held, keys = H.gold_dim_simple(held, short, self.plan.natural_id.get(name, keys[0])), [f"{short}_sk"]
        for short, dim, id_col, date_col in self.plan.versions.get(name, []):
            versions = self.read("gold", dim)
            if versions is not None:
                held, joined = H.effective_join(held, versions.hint("merge"), id_col, date_col, short), True
                unique = unique and H.one_at_a_time(versions, id_col)
        _, m = self._upsert("gold", name, held, keys, unique=unique, some=some, rebalance=part is None or joined)
        self._told("gold", "gold", name, m)
        return affected

    def _versioned(self, t: Row, batch: DataFrame | None, changes: DataFrame | None, date: str) -> int:
        """A dimension with history: bronze, then the whole image with the landed
        attribute changes against the versions so far (D11, E07)."""
        name, keys, affected = t.table_name, list(t.business_keys), 0
        if batch is not None:
            _, m = self._upsert("bronze", name, batch, keys, [PARTITION_COL, "_landed_at"])
            affected = m["inserted"] + m["updated"]
            self._told("bronze", "bronze", name, m)
        image = DQ.cleanse(self.read("bronze", name)).drop(PARTITION_COL)
        if changes is not None:
            image = DQ.apply_changes(image, changes.where(F.col("table_name") == name), keys[0], as_of=date)
        image = self._split(name, image, date)
        old = self.read("silver", name)
        start = date if old is not None else self.plan.first_date
        d = F.lit(start).cast("date")
        new = H.apply_scd2(old, image, keys, list(t.track_attrs), start)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.plan.buckets)).cast("int")
        seen = Observation()
        staged = replace_partitions(new.withColumn(BUCKET, bucket), self.path("silver", name), BUCKET, observe=(seen, [
            F.count_if(F.col("is_current") & (F.col("effective_from") == d)).alias("inserted"),
            F.count_if(~F.col("is_current") & (F.col("effective_to") == d)).alias("closed")]))
        self.audit("silver", "silver", name, seen.get["inserted"] + seen.get["closed"],
                   message=f"scd2 ins={seen.get['inserted']} closed={seen.get['closed']}")
        short = name.removeprefix("dim_")
        touched = staged.drop(BUCKET).where((F.col("effective_from") == d) | (F.col("effective_to") == d))
        _, m = self._upsert("gold", name, H.gold_dim_scd2(touched, short, keys[0]), [f"{short}_sk"])
        self._told("gold", "gold", name, m)
        return affected

    def take(self, t: Row) -> None:
        """One table through all layers: its landing partitions behind its watermark."""
        mark = self.watermark(t.table_name)
        landed = read_if_exists(self.spark, self.path("landing", t.table_name))
        changes = read_if_exists(self.spark, self.path("landing", "dim_changes")) if t.is_scd2 else None
        newest = lambda df: None if df is None else new_since(df, mark).agg(
            F.max(PARTITION_COL).cast("string")).first()[0]
        date, changed = newest(landed), None
        if changes is not None and self.read("bronze", t.table_name) is not None:
            changed = newest(changes.where(F.col("table_name") == t.table_name))
        if date is None and changed is None:  # O04: nothing new
            return
        batch = None if date is None else new_since(landed, mark)
        upto = max(x for x in (date, changed) if x)
        rows = self._versioned(t, batch, changes, upto) if t.is_scd2 else self._keyed(t, batch, upto)
        self.advance(t.table_name, upto, rows)

    def _guard(self, step: str, layer: str, table: str):
        run = self

        class Guard:
            def __enter__(self):
                return self

            def __exit__(self, kind, error, trace):
                if error is not None and isinstance(error, Exception):
                    run.audit(step, layer, table, 0, "FAILED", f"{kind.__name__}: {str(error).splitlines()[0][:200]}")
                    return True
                return False

        return Guard()

    def run(self, mode: str, date: str) -> None:
        """Land, then every table in load order; a failure stays with its table."""
        if mode not in ("bulk", "daily"):
            raise ValueError(f"unknown mode {mode!r}")
        self.land(mode, date)
        for t in self.tables:
            with self._guard("take", "all", t.table_name):
                self.take(t)


def next_day(run: RegistryRun, start: str, end: str, table: str) -> str | None:
    """The earliest day of the window behind the table's watermark."""
    window = run.spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    day = C.next_day(window, F.lit(run.watermark(table)).cast("date")).first()[0]
    return None if day is None else str(day)


def run_registry(spark: SparkSession, plan: Plan, registry: DataFrame, mode: str, date: str) -> RegistryRun:
    """Run one bulk load or one day; returns the run for its tables and control rows."""
    run = RegistryRun(spark, plan, registry)
    run.run(mode, date)
    return run
