"""Session helpers: a tuned local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "weeklens") -> SparkSession:
    """Local session used by tests and bench. Cluster jobs bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it from the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only pick a
    local temporary folder when nothing is configured *and* the master is local
    (tests). On a cluster without a configured folder we refuse instead of
    silently writing to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster is a cluster
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="weeklens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name if "://" in base else os.path.join(base, name)
