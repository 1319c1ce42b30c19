"""Spark session helpers.

Everything in the package runs on whatever session the caller passes in; these helpers only
build a sensible local session (tests, bench) and locate the shared folder for written
intermediate tables.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Settings the package relies on. AQE re-plans joins and partition counts at run time from the
# measured shuffle sizes, which is what keeps the plans free of hand-picked partition numbers.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = "local[*]",
    app_name: str = "revspark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with ``DEFAULT_CONF``. ``master=None`` leaves the master to whoever launched
    the process (``spark-submit --master ...``; local when run directly)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a given input size: one shuffle partition per ``partition_bytes`` of
    input (so each fits an executor's memory without spilling much); AQE coalesces small ones and
    splits skewed ones at run time."""
    parts = max(1, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes // 2),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only in local mode, where driver and
    executors are one process, an unset one becomes a folder beside the tables of
    ``spark.sql.warehouse.dir``; a cluster must name a folder that all its machines reach."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def sf_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` names, and a str -> Hadoop Path converter."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``, on whatever file system it names."""
    fs, to_path = file_system(spark, path)
    return int(fs.getContentSummary(to_path(path)).getLength())


def size_shuffle_for(spark: SparkSession, path: str) -> dict[str, str]:
    """Apply ``scale_conf`` for the input at ``path`` to the session (runtime SQL settings) and
    return what was set."""
    conf = scale_conf(input_bytes(spark, path))
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
