"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

MARKET_ZONE = "Asia/Kolkata"

#: Settings for a large cluster. Shuffles start wide and AQE merges small partitions,
#: so one value serves both a day's batch and a full-history rebuild.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A small local session with the same semantics as the cluster one."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bourseloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone; market-zone shifts are always explicit in the operators."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates and stream checkpoints.

    Lives under ``spark.checkpoint.dir``, the folder all executors share. Where that is not
    set, a session in one process (a test) gets a temporary folder; any cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="bourseloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
