"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume.  Event times are wall-clock TIMESTAMP_NTZ, so the
# session zone only matters for `now()`-style columns; pin it for reproducibility.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go when nothing refers to them
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "hourmeter") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # local mode: the driver JVM is the only executor
    builder = builder.config("spark.driver.memory", os.environ.get("HOURMETER_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local runs, tests) do we create a private one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="hourmeter-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        pass
    return current


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage-cutting tables (never a machine-local temp dir on a cluster)."""
    return ensure_checkpoint_dir(spark)
