"""Session defaults and the few session-level settings the operators read."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Largest side (estimated in-memory bytes) the operators broadcast on their own.
# Beyond it they fall back to shuffled joins. Overridable per session with
# ``spark.conf.set("bowline.broadcastLimitBytes", ...)``.
DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024


def get_session(master: str | None = None, app_name: str = "bowline",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the engine expects.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints that nothing refers to any more (earlier weights) are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage and hold written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    directory). Only when neither is set - local tests - a folder is made here.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="bowline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def durable_path(spark: SparkSession, *parts: str) -> str:
    """A path for tables that outlive the application (caches, models): below
    ``bowline.workDir``, else ``spark.checkpoint.dir`` itself, else (local
    tests, where neither is set) the application's own checkpoint folder."""
    base = spark.conf.get("bowline.workDir", None) or spark.conf.get("spark.checkpoint.dir", None) \
        or checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "bowline", *parts])


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "bowline", *parts])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed: its
    folder goes on the path of workers started on the same machine. A cluster
    gets it with ``--py-files`` or an installed package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def broadcast_limit_bytes(spark: SparkSession) -> int:
    value = spark.conf.get("bowline.broadcastLimitBytes", None)
    return int(value) if value else DEFAULT_BROADCAST_LIMIT


__all__ = ["get_session", "checkpoint_dir", "work_path", "broadcast_limit_bytes",
           "durable_path", "DEFAULT_BROADCAST_LIMIT"]
