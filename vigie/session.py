"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def builder(name: str) -> SparkSession.Builder:
    """Settings that matter on a cluster: adaptive plans, skew splitting, sane scan splits."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.files.maxPartitionBytes", "256m")
    )


def cluster_session(name: str, shuffle_partitions: int = 20000) -> SparkSession:
    """A session for large data: many small shuffle partitions that AQE merges as needed.

    Master, memory, executors and ``spark.checkpoint.dir`` come from the cluster.
    """
    return (
        builder(name)
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",  # state beyond a task's memory
        )
        .getOrCreate()
    )


def local_session(name: str, cores: int | str = 8) -> SparkSession:
    spark = (
        builder(name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", os.environ.get("VIGIE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="vigie-")


def work_root(configured: str | None, master: str, application: str) -> str:
    """The shared folder that the cluster names; a local session may make its own."""
    if configured:
        return configured.rstrip("/")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_folder(application)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    root = work_root(spark.conf.get("spark.checkpoint.dir", None), context.master, context.applicationId)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
