"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the jobs rely on. Shuffle partition counts and memory stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Raw time columns arrive as 64-bit nanoseconds.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Joins are planned by the sizes of compressed files. Rows take several times that in memory, and more as text
    # keys and hashes; without the factor a side of a million rows counts as small and goes through the driver.
    "spark.sql.sources.fileCompressionFactor": "10.0",
    # Overwrite only the partitions that a write contains.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings, leaving alone what the cluster set explicitly."""
    explicit = spark.sparkContext.getConf()
    for key, value in RUNTIME_CONF.items():
        if not explicit.contains(key):
            spark.conf.set(key, value)
    return spark


def compact(spark: SparkSession) -> SparkSession:
    """Results and tables are written with zstd, unless the cluster says otherwise.

    Surrogate keys are hashes in hex, which the default codec leaves as long as they are and this one halves.
    """
    key = "spark.sql.parquet.compression.codec"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, "zstd")
    return spark


def build_session(app_name: str = "leadmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session without that setting falls back to a folder of its own machine, which goes when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="leadmill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"leadmill-{purpose}-{uuid.uuid4().hex}")
