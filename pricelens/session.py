"""Session helpers: one place for the configuration the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pricelens", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, UTC dates and dynamic overwrite.

    On a cluster the master and checkpoint directory come from the
    submitter; only when they are unset (tests, local runs) do we fill them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # only effective when this call starts the JVM (local runs); in local mode the
        # driver heap is also the executors' heap
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        # checkpointed small sides are removed once no DataFrame references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Session-level settings the library depends on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # lists of ids up to this length reach Parquet one by one, not as their range (operators.history)
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "500")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a fresh
    scratch folder is created and registered.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path for staging tables inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])
