"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (a
# dimension that turns out small becomes a broadcast; a skewed partition of a
# fact, e.g. the guest-customer NULL key, is split), coalesces small shuffle
# partitions, and the broadcast threshold is the size check behind every join
# the library does not hint itself.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    On a cluster, pass ``master=None`` so the submitter's master is used.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and published tables.

    Uses the cluster's ``spark.checkpoint.dir``; only when it is unset (local
    tests) a fresh scratch folder is made and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not (spark.sparkContext.master + "[").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
    return d
