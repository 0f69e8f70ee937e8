"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every entry point uses. AQE re-plans joins from runtime
# sizes (broadcast conversion, partition coalescing, skew-join splitting).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int, input_bytes: float | None = None,
                 partition_bytes: int = 256 << 20) -> dict:
    """Settings for a large cluster, sized so every task's input fits in
    executor memory and spills gracefully.

    * shuffle partitions: enough that a shuffle of ``input_bytes`` lands at
      about ``partition_bytes`` per partition, between 3 and 10 waves of the
      cluster's cores (a shuffle is far smaller than the input once columns
      are pruned and aggregates combined map-side, and more partitions only
      multiply shuffle blocks); AQE then coalesces small shuffles and splits
      skewed partitions (a key holding a third of the rows is cut into
      pieces of the advisory size);
    * file splits of ``partition_bytes``;
    * broadcast by size only up to 64 MB (dimension checks use row bounds).
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, min(int(input_bytes // partition_bytes) + 1, 10 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wardmart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    On a cluster ``master`` stays None so spark-submit decides, and the
    settings of ``cluster_conf`` for its cores are applied; locally the
    caller passes ``local[N]`` and a matching shuffle-partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor; the default
            # catalog folder goes to a scratch folder, not the working dir
            conf["spark.driver.memory"] = os.environ.get("WARDMART_DRIVER_MEMORY", "4g")
            conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="wardmart-catalog-",
                                                               dir="/tmp")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        sized = cluster_conf(spark.sparkContext.defaultParallelism)
        for k, v in sized.items():
            if k not in conf:
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and materialized tables.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder). Only when it is unset on a single-machine ``local[..]`` master
    a scratch folder is set; on a cluster that is an error, since executors
    do not see each other's local files.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        path = tempfile.mkdtemp(prefix="wardmart-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def warehouse_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder under which materialized models are written."""
    return checkpoint_root(spark, fallback).rstrip("/") + "/warehouse"
