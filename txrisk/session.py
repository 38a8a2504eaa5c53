"""Session helpers: local sessions for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "txrisk") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local session may leave it unset: it gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="txrisk-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder (never machine-local on a cluster)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/txrisk-{name}-{uuid.uuid4().hex[:12]}"
