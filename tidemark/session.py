"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app_name: str = "tidemark", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on: UTC times, adaptive joins, per-group top-N pruning."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # newest-N per asset asks for up to 1,440 rows per group; the default threshold is 1,000
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2000")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from the session; only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    current = getattr(scratch_root, "_local", None)
    if current is None:
        current = tempfile.mkdtemp(prefix="tidemark-")
        scratch_root._local = current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
