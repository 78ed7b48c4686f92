"""Session settings the jobs rely on, and the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

SHUFFLE_TARGET = 256 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, least: int = 200) -> int:
    """How many partitions a shuffle of that size starts with: few enough bytes
    in each to be sorted in memory. Adaptive execution joins them where a
    shuffle turns out smaller, but it never splits an evenly filled one."""
    return max(least, -(-shuffle_bytes // SHUFFLE_TARGET))


def build_session(
    app_name: str = "gridtide", master: str | None = None, shuffle_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above, and shuffles sized for the data if
    ``shuffle_bytes`` tells how much the widest of them carries. ANSI mode
    stays at Spark's default: leniency belongs to single expressions, never to
    the whole session."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_bytes is not None:
        extra = {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes)), **extra}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder the cluster names in
    ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder; a cluster without the setting is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="gridtide-")
    return os.path.join(root, name)
