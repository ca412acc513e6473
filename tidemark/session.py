"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Everything here is a stock Spark setting.  Partition counts and sizes are left
# to AQE so that the same code runs on one machine and on a large cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # capturing a call site for every column makes large expressions slow to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tidemark", **overrides: str) -> SparkSession:
    """Create (or fetch) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path that every executor can reach.

    It lies under ``spark.checkpoint.dir``.  Only a local session, where driver and
    executors share one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame (file sizes scaled by the kept columns).

    The estimate costs no job.  Unknown sources report a huge number, so a check
    against a limit fails safe.
    """
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))
