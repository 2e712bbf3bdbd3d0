"""Session helpers: time zone, checkpoint folder, local test sessions.

All stored times are UTC; the library pins the session zone so that
``timestamp`` arithmetic, window labels and ``toPandas`` agree.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's checkpoint folder; only set one where none is set.

    Without ``spark.checkpoint.dir`` a local-mode session (tests, the bench)
    gets a scratch folder; a cluster session must name a shared folder,
    because a machine-local one would not survive the loss of an executor.
    """
    d = checkpoint_dir(spark)
    if d is None:
        master = spark.sparkContext.master or ""
        if fallback is None and not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        d = fallback or tempfile.mkdtemp(prefix="fleetcast-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fleetcast") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # coalesce shuffle partitions to the advisory size, not to the core count
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FLEETCAST_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_utc(spark)
