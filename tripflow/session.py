"""SparkSession helpers.

On a cluster the session is created by the platform; we only read its settings.
``local_session`` is for tests and the bench: it pins the settings the engine
relies on (UTC session zone, ANSI, AQE) and points ``spark.checkpoint.dir`` at a
scratch folder *only when the session has none*.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tripflow") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # tests and bench leave no stale files
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only in local mode when none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is useless to other executors: a cluster must name a shared one
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="tripflow-ckpt-", dir=os.environ.get("TRIPFLOW_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for tables that cut lineage."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
