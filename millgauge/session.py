"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The cluster's own values win where they are set
# at submit time; these only fill the gaps for a session built here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Recording the caller of every column expression costs more than planning it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "millgauge", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps in this library are UTC wall clock; hold the session to that."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workspace(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="millgauge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is reused or deleted."""
    return f"{workspace(spark)}/millgauge/{name}-{uuid.uuid4().hex}"
