"""Change tables read by position.

The changes of a table are an ordinary Parquet table partitioned by
``_commit_version``, a partition per commit with its commit time. Writing a
version again replaces its partition, so a retried commit doubles nothing. What a
consumer has taken over is a row of a control table; its next read starts behind
that version and is a partition filter, so only newer folders are listed and read.

A consumer without a position, or with one that lies before the oldest version
still kept, gets the table itself in full, as inserts.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import column_list
from strata.operators.merge import dedup_latest, merge_upsert
from strata.sources.tables import read_if_exists

VERSION, TIME, KIND = "_commit_version", "_commit_timestamp", "_change_type"
POSITIONS = "consumer string, table_name string, last_version long"


def commit_changes(changes: DataFrame, path: str, version: int, at: Column | None = None) -> None:
    """Write the changes of one version (rows of ``change_feed``)."""
    stamped = changes.withColumn(TIME, (at if at is not None else F.current_timestamp()).cast("timestamp"))
    stamped.drop(VERSION).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{VERSION}={version}")


def versions_kept(changes: DataFrame | None) -> tuple[int | None, int | None]:
    """Oldest and newest version in the change table (of the partition column)."""
    if changes is None:
        return None, None
    return tuple(changes.agg(F.min(VERSION), F.max(VERSION)).first())


def changes_between(changes: DataFrame, after: int | None = None, upto: int | None = None,
                    since: str | None = None, with_deletes: bool = False) -> DataFrame:
    """Inserts and post-images (and deletes, if asked for) of the versions
    after ``after`` up to ``upto``, or of the commits from a time on. The versions
    are a filter on the partition column."""
    kinds = ["insert", "update_postimage"] + (["delete"] if with_deletes else [])
    out = changes.where(F.col(KIND).isin(kinds))
    if after is not None:
        out = out.where(F.col(VERSION) > after)
    if upto is not None:
        out = out.where(F.col(VERSION) <= upto)
    return out if since is None else out.where(F.col(TIME) >= F.lit(since).cast("timestamp"))


def last_change(changes: DataFrame, keys) -> DataFrame:
    """One row per key: what the newest version says."""
    return dedup_latest(changes, column_list(keys), [VERSION, KIND])


def apply_changes_to(target: DataFrame | None, changes: DataFrame, keys) -> DataFrame:
    """The target after the changes: deleted keys go, the others are upserted."""
    keys = column_list(keys)
    last = last_change(changes, keys)
    put = last.where(F.col(KIND) != "delete").drop(KIND, VERSION, TIME)
    if target is None:
        return put
    gone = last.where(F.col(KIND) == "delete").select(*keys)
    return merge_upsert(target.join(gone, keys, "left_anti"), put, keys, assume_unique=True)


class ChangeReader:
    """Reads of one change table by named consumers; positions under ``control``."""

    def __init__(self, spark: SparkSession, table_name: str, path: str, control: str):
        self.spark, self.table_name, self.path = spark, table_name, path
        self.control = os.path.join(control, "change_positions", f"table_name={table_name}")

    def changes(self) -> DataFrame | None:
        return read_if_exists(self.spark, self.path)

    def position(self, consumer: str) -> int | None:
        kept = read_if_exists(self.spark, f"{self.control}/consumer={consumer}")
        return None if kept is None else kept.agg(F.max("last_version")).first()[0]

    def read(self, consumer: str, current: DataFrame, with_deletes: bool = True) -> tuple[DataFrame, int | None]:
        """(changes since the consumer's position, version they reach). The caller
        calls ``advance`` with that version once it has written what it made of
        them; without it the next read gives the same changes again."""
        changes, at = self.changes(), self.position(consumer)
        oldest, newest = versions_kept(changes)
        if changes is None or at is None or oldest > at + 1:
            whole = current.withColumn(KIND, F.lit("insert")).withColumn(VERSION, F.lit(newest).cast("long"))
            return whole.withColumn(TIME, F.lit(None).cast("timestamp")), newest
        return changes_between(changes, at, newest, with_deletes=with_deletes), newest

    def advance(self, consumer: str, version: int | None) -> None:
        """Store the position: one row, replacing the consumer's own only."""
        if version is not None:
            self.spark.createDataFrame([(version,)], "last_version long").coalesce(1).write.mode("overwrite").parquet(
                f"{self.control}/consumer={consumer}")
