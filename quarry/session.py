"""Session helpers.

Library functions never create sessions; they take DataFrames.  These helpers
are for scripts, tests and the bench: UTC, AQE on, no UI, and a checkpoint
directory only when the cluster has not named one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # JSON objects with repeated keys keep the last value (as Python's
        # json.loads does) instead of failing to parse
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.driver.memory": os.environ.get("QUARRY_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Otherwise a folder already registered with ``setCheckpointDir`` is
    reused.  When neither exists, a session in one JVM (``local[..]``, as in
    tests) gets a temporary folder; on a cluster that is an error, since
    executors would each write to their own disk.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None)
    sc = spark.sparkContext
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    registered = sc.getCheckpointDir()
    if registered:
        return registered
    if not (default or (sc.master.startswith("local") and not sc.master.startswith("local-cluster"))):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    local = default or tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def cluster_conf(input_bytes: int, shuffle_ratio: float = 0.3,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the input volume.

    * ``spark.sql.files.maxPartitionBytes`` 128 MB: text analysis is CPU-bound,
      so moderate splits keep every core busy and a failed task cheap to redo.
    * ``spark.sql.shuffle.partitions``: enough partitions that the largest
      shuffle (postings / keyed merges, ``shuffle_ratio`` of the input) lands
      near ``target_partition_bytes`` each - AQE only coalesces, it never
      splits a too-large partition (except skewed join partitions).
    * AQE coalescing + skew join on; broadcast only below 64 MB of *runtime*
      size; the checkpoint folder must be a shared path set by the cluster.
    """
    shuffle_parts = max(200, int(input_bytes * shuffle_ratio / target_partition_bytes) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
    }
