"""Session helpers: the shared scratch folder and a local session for tests."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, read from ``spark.checkpoint.dir``.

    On a cluster this names shared storage. Only a local session without one
    gets a folder made and registered; elsewhere a missing setting is an error,
    as each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name shared storage on {master}")
        root = tempfile.mkdtemp(prefix="feedlake-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch root."""
    return f"{scratch_root(spark)}/feedlake/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench: UI off, AQE on, UTC clock."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
