"""Parquet sinks: keyed by batch so that a replayed batch replaces itself."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BATCH_LOG


def write_batch(df: DataFrame, path: str, batch_id: int | str, partitions: Sequence[str] = ()) -> None:
    """Write one micro-batch into its own partition folder.

    Writing it again replaces the folder, also when there is nothing left to write.
    Readers of ``path`` see ``batch_id`` as a partition column.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(batch_path(path, batch_id))


def batch_path(path: str, batch_id: int | str) -> str:
    return f"{path}/batch_id={batch_id}"


def latest(versions: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """Newest version of every key. An aggregate, so partial results shrink before the shuffle."""
    rest = [c for c in versions.columns if c not in keys]
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def write_monthly(df: DataFrame, path: str, ts: str = "event_ts", cluster: Sequence[str] = ()) -> None:
    """Fact by month of ``ts``; files sorted by time so that min/max statistics prune."""
    (
        df.withColumn("event_month", F.date_format(ts, "yyyyMM"))
        .sortWithinPartitions("event_month", *cluster, ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month")
        .parquet(path)
    )


def _log_row(spark: SparkSession, row: tuple) -> DataFrame:
    return spark.createDataFrame([row], BATCH_LOG)


def log_batch(
    spark: SparkSession,
    path: str,
    job: str,
    batch_id: str | None,
    started: dt.datetime,
    status: str,
    rows: int | None = None,
    error: str | None = None,
) -> None:
    done = None if status == "RUNNING" else dt.datetime.now(dt.timezone.utc)
    row = (job, batch_id, started, done, rows, status, error or None)
    _log_row(spark, row).coalesce(1).write.mode("append").parquet(path)


def run_logged(spark: SparkSession, path: str, job: str, run_id: str, work: Callable[[], int]) -> int:
    """Run ``work`` with a RUNNING row before and a SUCCESS or FAILED row after."""
    started = dt.datetime.now(dt.timezone.utc)
    log_batch(spark, path, job, run_id, started, "RUNNING")
    try:
        rows = work()
    except Exception as exc:
        log_batch(spark, path, job, run_id, started, "FAILED", error=str(exc))
        raise
    log_batch(spark, path, job, run_id, started, "SUCCESS", rows=rows)
    return rows


def run_outcomes(log: DataFrame) -> DataFrame:
    """One row per run: the last state it reached. RUNNING and repeated rows of a run count once."""
    rank = F.when(F.col("status") == "RUNNING", 0).otherwise(1)
    return (
        log.groupBy("job_name", "batch_id")
        .agg(F.max_by(F.struct(*[c for c in log.columns if c not in ("job_name", "batch_id")]),
                      F.struct(rank, F.col("completed_at"))).alias("r"))
        .select("job_name", "batch_id", "r.*")
    )
