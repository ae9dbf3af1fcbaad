"""SparkSession construction and shared-folder lookup."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every popflow job wants regardless of cluster size. Partition
# counts are left to the cluster (AQE coalesces small shuffles at runtime).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit a per-batch changelog of state changes instead of uploading a
    # RocksDB snapshot every micro-batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Remove reliable-checkpoint files (compaction) once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "popflow",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    Uses ``spark.checkpoint.dir`` as configured for the session; only when it
    is unset on a ``local`` master is a default under the working directory
    chosen; on a cluster an unset folder is an error, never a machine-local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.abspath("popflow-checkpoints")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])
