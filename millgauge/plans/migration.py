"""Backfill of the star from the first-generation tables, with a reconciliation report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.numeric import minutes_between, num, percent
from ..functions.text import contains
from ..operators import production
from ..operators.alerts import occurrences
from ..operators.joins import lookup
from ..operators.sequence import number_gaps

DEFAULT_STOP_STATUS = "FAULT"
DEFAULT_ALERT = "FAULT_STATUS"


def _keys(df: DataFrame, ts: str, machines: DataFrame, minutes_of_day: DataFrame) -> DataFrame:
    """Date, time, machine and shift keys; the shift comes from the time dimension."""
    out = df.withColumns({"date_key": keys.date_key(F.col(ts)), "time_key": keys.time_key(F.col(ts))})
    out = lookup(out, machines.where("is_current").select("machine_id", "machine_key"), "machine_id")
    out = lookup(out, minutes_of_day.select("time_key", "shift_key"), "time_key")
    return out.withColumns(
        {"machine_key": keys.or_unknown(F.col("machine_key")),
         "shift_key": keys.or_unknown(F.col("shift_key")).cast("smallint")}
    )


def backfill_sensor(readings: DataFrame, machines: DataFrame, statuses: DataFrame, minutes_of_day: DataFrame) -> DataFrame:
    rows = _keys(readings.where("event_time IS NOT NULL"), "event_time", machines, minutes_of_day)
    dim = statuses.where("status_key > 0").select("status_key", "status_code")
    rows = lookup(rows, dim, F.upper("status") == F.col("status_code")).withColumns(
        {
            "status_key": keys.or_unknown(F.col("status_key")).cast("smallint"),
            "flags_key": keys.flags_key(F.col("temperature_c")),
            "event_date": F.to_date("event_time"),
        }
    )
    return production.sensor_fact(rows)


def backfill_alerts(
    alerts: DataFrame, machines: DataFrame, alert_types: DataFrame, minutes_of_day: DataFrame,
    gap_minutes: float = 5,
) -> DataFrame:
    """Islands of repeated alerts become one row; acknowledged ones get assumed times."""
    kept = occurrences(alerts, ["machine_id", "alert_type"], "event_time", ["alert_id"], gap_minutes)
    rows = _keys(kept.drop("_prev_ts"), "event_time", machines, minutes_of_day)
    dim = alert_types.where("alert_type_key > 0").select("alert_type_key", F.col("alert_code").alias("alert_type"))
    fallback = dim.where(F.col("alert_type") == DEFAULT_ALERT).agg(F.min("alert_type_key").alias("_default"))
    rows = lookup(rows, dim, "alert_type").crossJoin(F.broadcast(fallback))  # one row, whatever the table holds
    after = lambda minutes: F.when(
        F.col("acknowledged"), F.col("event_time") + F.expr(f"INTERVAL {minutes} MINUTES")
    )
    return rows.select(
        "alert_id", "date_key", "time_key", "machine_key",
        F.coalesce("alert_type_key", "_default").alias("alert_type_key"),
        "shift_key",
        F.col("event_time").alias("raised_at"),
        after(10).alias("acknowledged_at"),
        after(25).alias("resolved_at"),
        F.lit(1).alias("alert_count"),
        "message",
    )


def planned_reason(reason: Column, legacy: bool = False) -> Column:
    """Reason text names planned work. ``legacy`` also counts 'unplanned', as the text contains it."""
    hit = contains(reason, "planned", "maintenance")
    return hit if legacy else hit & ~contains(reason, "unplanned")


def backfill_downtime(
    events: DataFrame, machines: DataFrame, statuses: DataFrame, minutes_of_day: DataFrame,
    as_of: DataFrame, legacy_reason: bool = False,
) -> DataFrame:
    """Stops with a duration; an open one lasts until ``as_of`` (one row, one column)."""
    rows = _keys(events, "start_time", machines, minutes_of_day)
    status = statuses.where(F.col("status_code") == DEFAULT_STOP_STATUS).select("status_key")
    now = as_of.toDF("_now")
    rows = rows.crossJoin(F.broadcast(status)).crossJoin(F.broadcast(now))  # one row each
    elapsed = minutes_between(F.col("start_time"), F.coalesce("end_time", "_now"))
    return rows.select(
        "event_id", "date_key", "time_key", "machine_key", "status_key", "shift_key",
        F.col("start_time").alias("started_at"), F.col("end_time").alias("ended_at"),
        F.coalesce("duration_minutes", elapsed).alias("duration_minutes"),
        planned_reason(F.col("reason_code"), legacy_reason).alias("is_planned"),
        "reason_code",
    )


def backfill_hourly(minutes: DataFrame, machines: DataFrame, planned: DataFrame) -> DataFrame:
    return production.rollup_minutes(minutes, machines, planned, daily_share=True)


def consolidate(events: DataFrame, gap_seconds: int = 300) -> DataFrame:
    """Raw stop rows into episodes: a row starts an episode unless it begins within
    the gap after the latest end so far; the episode ends with that."""
    end = F.coalesce("end_time", "start_time")
    numbered = number_gaps(events, ["machine_id"], "start_time", ["event_id"], end, gap_seconds)
    return numbered.groupBy("machine_id", "episode").agg(
        F.min("start_time").alias("started_at"),
        F.max(end).alias("ended_at"),
        F.count("*").alias("raw_events"),
    )


def reconciliation(star, sensor: DataFrame, alerts: DataFrame, stops: DataFrame, hourly: DataFrame) -> DataFrame:
    """Source and target counts, unknown keys and the share of alert rows removed.

    Every table is counted in one pass; the one-row results are turned on their side. Given stored tables, a table is read once.
    """
    n = lambda df, name: df.agg(F.count("*").alias(name))
    row = (
        n(star.readings, "source readings")
        .crossJoin(
            sensor.agg(
                F.count("*").alias("target fact_sensor_reading"),
                F.count_if(F.col("machine_key") == -1).alias("unknown machine_key rows"),
                F.count_if(F.col("status_key") == -1).alias("unknown status_key rows"),
            )
        )
        .crossJoin(n(star.failure_alerts, "source failure_alerts"))
        .crossJoin(n(alerts, "target fact_alert"))
        .crossJoin(n(star.downtime_events, "source downtime_events"))
        .crossJoin(n(stops, "target fact_downtime"))
        .crossJoin(n(star.minute_kpis, "source machine_kpi_1min"))
        .crossJoin(n(hourly, "target fact_production_hourly"))
    )
    removed = percent(
        F.col("source failure_alerts") - F.col("target fact_alert"), F.col("source failure_alerts")
    )
    row = row.withColumn("alert dedup reduction pct", removed)
    return row.unpivot([], [num(F.col(f"`{x}`")).alias(x) for x in row.columns], "metric", "value")
