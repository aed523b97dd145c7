"""Downtime episodes: batch form, micro-batch form, guarded close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import minutes_between
from .joins import small
from .sequence import episodes, newest_per, ordered_columns

STOP_STATUSES = ("DOWN", "FAULT")


def is_down(stop_statuses: tuple[str, ...] | None = None) -> Column:
    """Down by the status dimension; or, with a list, by those exact codes only."""
    if stop_statuses is not None:
        return F.coalesce(F.col("status").isin(*stop_statuses), F.lit(False))
    by_dim = F.coalesce(F.col("is_downtime"), F.lit(False))
    return by_dim | F.coalesce(F.upper("status").isin(*STOP_STATUSES), F.lit(False))


def duration(start: Column, end: Column) -> Column:
    return F.round(minutes_between(start, end), 2)


def downtime_fact(conformed: DataFrame) -> DataFrame:
    """One row per continuous stop of a machine, from any span of readings."""
    runs = episodes(conformed, ["machine_id"], "event_time", ["reading_id"], is_down())
    return runs.select(
        "date_key", "time_key", "machine_key", "status_key", "shift_key", "machine_id",
        F.col("event_time").alias("started_at"),
        "ended_at",
        duration(F.col("event_time"), F.col("ended_at")).alias("duration_minutes"),
        F.coalesce("is_planned_downtime", F.lit(False)).alias("is_planned"),
        F.upper("status").alias("reason_code"),
        F.col("ended_at").isNull().alias("is_open"),
    )


def status_episodes(readings: DataFrame) -> DataFrame:
    """Earlier form: stops by exact DOWN or FAULT status, straight from readings."""
    runs = episodes(readings, ["machine_id"], "event_time", ["reading_id"], is_down(STOP_STATUSES))
    return runs.select(
        F.col("reading_id").alias("event_id"),
        "machine_id",
        F.col("event_time").alias("start_time"),
        F.col("ended_at").alias("end_time"),
        duration(F.col("event_time"), F.col("ended_at")).alias("duration_minutes"),
        F.col("status").alias("reason_code"),
    )


def split_runs(rows: DataFrame, down: Column, open_episodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(starts, ends) of one micro-batch, seeded with the stops still open before it.

    ``open_episodes`` has machine_id and open_started_at, one row per machine. Starts
    keep all columns of their first row; ends are machine_id, started_at, ended_at.
    A row not later than the start of its machine's open stop arrived late and changes nothing.
    """
    seed = open_episodes.select("machine_id", "open_started_at")
    marked = rows.withColumn("_down", down).join(
        small(seed.withColumnRenamed("machine_id", "_of").withColumnRenamed("open_started_at", "_open")), F.col("machine_id") == F.col("_of"), "left")
    marked = marked.where(F.col("_open").isNull() | (F.col("event_time") > F.col("_open"))).drop("_of", "_open")
    # Runs of this batch; one that continues an open stop is not a new stop.
    runs = ordered_columns(
        marked, ["machine_id"], "event_time", ["reading_id"],
        lag={"_prev": F.col("_down")},
        following={"ended_at": F.when(~F.col("_down"), F.col("event_time"))},
    ).where(F.col("_down") & ~F.coalesce("_prev", F.lit(False)))
    runs = runs.join(small(seed), "machine_id", "left")
    starts = runs.where(F.col("_prev").isNotNull() | F.col("open_started_at").isNull())
    ended = starts.where("ended_at IS NOT NULL").select(
        "machine_id", F.col("event_time").alias("started_at"), "ended_at"
    )
    # A stop open from before ends with the first up row of its machine.
    first_up = marked.where(~F.col("_down")).groupBy("machine_id").agg(F.min("event_time").alias("ended_at"))
    carried = seed.join(first_up, "machine_id").select(
        "machine_id", F.col("open_started_at").alias("started_at"), "ended_at"
    )
    return starts, ended.unionByName(carried)


def batch_changes(conformed: DataFrame, open_episodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(opened, closed) stops of one micro-batch in fact shape."""
    starts, ends = split_runs(conformed, is_down(), open_episodes)
    opened = starts.select(
        "machine_id", "date_key", "time_key", "machine_key", "status_key", "shift_key",
        F.col("event_time").alias("started_at"),
        F.coalesce("is_planned_downtime", F.lit(False)).alias("is_planned"),
        F.upper("status").alias("reason_code"),
    )
    return opened, ends


def status_changes(readings: DataFrame, open_episodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(opened, closed) by exact DOWN or FAULT status: the earlier state machine."""
    starts, ends = split_runs(readings, is_down(STOP_STATUSES), open_episodes)
    opened = starts.select(
        F.col("reading_id").alias("event_id"), "machine_id",
        F.col("event_time").alias("started_at"), F.col("status").alias("reason_code"),
    )
    return opened, ends


def still_open(before: DataFrame, opened: DataFrame, closed: DataFrame) -> DataFrame:
    """Open stops after a batch: those before and the new ones, less the closed."""
    keys = ["machine_id", "open_started_at"]
    started = lambda df: df.select("machine_id", F.col("started_at").alias("open_started_at"))
    return before.select(*keys).unionByName(started(opened)).join(started(closed), keys, "left_anti")


def as_open(opened: DataFrame) -> DataFrame:
    """Start rows with empty end columns, ready to be closed."""
    return opened.withColumns(
        {
            "ended_at": F.lit(None).cast("timestamp"),
            "duration_minutes": F.lit(None).cast("double"),
            "is_open": F.lit(True),
        }
    )


def close_episodes(fact: DataFrame, closed: DataFrame) -> DataFrame:
    """Guarded update: end and duration are set only where the stop is still open."""
    ends = closed.select("machine_id", "started_at", F.col("ended_at").alias("_end"))
    end = F.coalesce("ended_at", "_end")
    return (
        fact.join(ends, ["machine_id", "started_at"], "left")
        .withColumn("duration_minutes", F.when(F.col("ended_at").isNull(), duration(F.col("started_at"), end))
                    .otherwise(F.col("duration_minutes")))
        .withColumn("ended_at", end)
        .withColumn("is_open", F.col("ended_at").isNull())
        .select(*fact.columns)
    )


def newest_open(fact: DataFrame, key: str = "machine_id", start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Latest stop without an end, per machine."""
    return newest_per(fact.where(F.col(end).isNull()), [key], [start])
