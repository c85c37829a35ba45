"""Session settings and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; a cluster may override the sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Bucketed tables with one file for each bucket are read as sorted.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.ui.enabled": "false",
}


def build_session(cpus: str | int = "*", app: str = "tallyhouse", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    shuffles = "8" if cpus == "*" else str(cpus)
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": shuffles,
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for tables that a job writes and reads again."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to reliable storage and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
