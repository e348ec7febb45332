"""Session helpers.

The library never creates a session implicitly inside an operator; callers
pass DataFrames.  ``get_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quaestor", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read.
    Where it is unset (local tests) a fresh scratch folder is created once.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="quaestor-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def cluster_conf(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized for a cluster run over ``input_bytes`` of parquet.

    * scan splits of ``target_partition_bytes`` (maxPartitionBytes), so a task
      reads ~256 MB whatever the file layout;
    * initial shuffle partitions = input / target (at least 2 x cores), AQE
      then coalesces small ones to the advisory size and splits skewed ones;
    * broadcast threshold stays small (64 MB): only bounded frames are hinted,
      everything else is left to AQE's runtime sizes.
    For 100 TB and 256 MB partitions this gives ~400,000 initial shuffle
    partitions, coalesced at runtime.
    """
    parts = max(2 * executor_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }
