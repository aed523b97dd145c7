"""The eight first-generation indicator views as DataFrame functions.

``as_of`` replaces the wall clock; without it the newest reading is the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band
from ..functions.numeric import num, percent, ratio, steady_mean
from ..operators.joins import lookup, with_as_of
from ..operators.sequence import newest_per


def _within(ts: str, span: str) -> Column:
    return F.col(ts) >= F.col("as_of") - F.expr(f"INTERVAL {span}")


def _mean_where(col: str, cond: Column) -> Column:
    kept = F.when(cond, F.col(col))
    return ratio(F.sum(kept), F.count(kept))


def _recent(rows: DataFrame, as_of: Column | None, span: str, machine_ids: DataFrame | None) -> DataFrame:
    """Rows with the clock. Given every machine, rows before the span are left out at the scan; machines without rows are added back."""
    if as_of is None or machine_ids is None:
        return with_as_of(rows, "event_time", as_of)
    return rows.where(F.col("event_time") >= as_of - F.expr(f"INTERVAL {span}")).withColumn("as_of", as_of)


def _all_machines(found: DataFrame, as_of: Column | None, machine_ids: DataFrame | None) -> DataFrame:
    return found if as_of is None or machine_ids is None else machine_ids.join(found, "machine_id", "left")


def live_status(readings: DataFrame, master: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest reading per known machine and whether it is under five minutes old."""
    latest = newest_per(readings, ["machine_id"], ["event_time", "reading_id"])
    known = lookup(latest, master.select("machine_id", "machine_name", "machine_type", "location"),
                   "machine_id", "inner")
    clock = known.crossJoin(F.broadcast(readings.agg(F.max("event_time").alias("as_of")))) \
        if as_of is None else known.withColumn("as_of", as_of)
    return clock.select(
        "machine_id", "machine_name", "machine_type", "location", "status",
        F.col("event_time").alias("last_event_time"),
        num("temperature_c").alias("temperature_c"),
        num("power_kw").alias("power_kw"),
        F.when(_within("event_time", "5 MINUTES"), "ONLINE").otherwise("OFFLINE").alias("connectivity"),
    )


def average_temperature(readings: DataFrame, as_of: Column | None = None, machine_ids: DataFrame | None = None) -> DataFrame:
    rows = _recent(readings, as_of, "24 HOURS", machine_ids)
    hour, day = _within("event_time", "1 HOUR"), _within("event_time", "24 HOURS")
    found = rows.groupBy("machine_id").agg(
        _mean_where("temperature_c", hour).alias("avg_temp_last_1h"),
        _mean_where("temperature_c", day).alias("avg_temp_last_24h"),
        num(F.max(F.when(day, F.col("temperature_c")))).alias("max_temp_last_24h"),
    )
    return _all_machines(found, as_of, machine_ids)


def failure_alerts(alerts: DataFrame, master: DataFrame) -> DataFrame:
    named = lookup(alerts, master.select("machine_id", "machine_name"), "machine_id", "inner")
    return named.select(
        "alert_id", "machine_id", "machine_name", "event_time", "alert_type", "severity", "message",
        "acknowledged",
    ).orderBy(F.desc("event_time"), "alert_id")


def _daily(minutes: DataFrame) -> DataFrame:
    return minutes.withColumn("production_date", F.to_date("window_start"))


def utilization(minutes: DataFrame) -> DataFrame:
    total = F.col("running_seconds") + F.col("idle_seconds") + F.col("down_seconds")
    return (
        _daily(minutes)
        .groupBy("machine_id", "production_date")
        .agg(
            F.sum("running_seconds").alias("running_seconds"),
            F.sum("idle_seconds").alias("idle_seconds"),
            F.sum("down_seconds").alias("down_seconds"),
            F.sum(total).alias("total_seconds"),
        )
        .withColumn("utilization_pct", percent("running_seconds", "total_seconds"))
    )


def power_consumption(minutes: DataFrame) -> DataFrame:
    """Energy adds up; the day's power is the mean of its minute averages."""
    return (
        _daily(minutes)
        .groupBy("machine_id", "production_date")
        .agg(
            (num(F.sum("power_sum")) / 60).alias("total_kwh"),
            steady_mean("avg_power_kw").alias("avg_kw"),
        )
    )


def downtime(events: DataFrame) -> DataFrame:
    minutes = F.coalesce(F.col("duration_minutes"), F.lit(0.0)).cast("decimal(18,2)")
    total = num(F.sum(minutes))
    return (
        events.groupBy("machine_id", F.to_date("start_time").alias("production_date"))
        .agg(
            F.count("*").alias("downtime_events"),
            total.alias("total_downtime_minutes"),
            (total / F.count("*")).alias("avg_downtime_minutes"),
        )
    )


def predictive_maintenance(
    readings: DataFrame, alerts: DataFrame, as_of: Column | None = None, machine_ids: DataFrame | None = None
) -> DataFrame:
    """Drift of the last hour against the last six, with the day's alert count."""
    rows = _recent(readings, as_of, "6 HOURS", machine_ids)
    hour, six = _within("event_time", "1 HOUR"), _within("event_time", "6 HOURS")
    recent = rows.groupBy("machine_id").agg(
        _mean_where("temperature_c", hour).alias("temp_1h"),
        _mean_where("temperature_c", six).alias("temp_6h"),
        _mean_where("vibration_mm_s", hour).alias("vib_1h"),
        _mean_where("vibration_mm_s", six).alias("vib_6h"),
    )
    recent = _all_machines(recent, as_of, machine_ids)
    clock = alerts.where(F.col("event_time") >= as_of - F.expr("INTERVAL 24 HOURS")).withColumn("as_of", as_of) if as_of is not None else alerts.crossJoin(
        F.broadcast(readings.agg(F.max("event_time").alias("as_of")))
    )
    raised = clock.where(_within("event_time", "24 HOURS")).groupBy("machine_id").agg(
        F.count("*").alias("_n")
    )
    n = F.col("alerts_last_24h")
    temp, vib = F.col("temp_1h") - F.col("temp_6h"), F.col("vib_1h") - F.col("vib_6h")
    return (
        recent.join(raised, "machine_id", "left")
        .withColumn("alerts_last_24h", F.coalesce("_n", F.lit(0)))
        .select(
            "machine_id", "temp_1h", "temp_6h", F.round(temp, 2).alias("temp_drift"),
            "vib_1h", "vib_6h", F.round(vib, 2).alias("vib_drift"), "alerts_last_24h",
            band(
                ((n >= 3) | (temp > 5) | (vib > 2), "HIGH_RISK"),
                ((n >= 1) | (temp > 2), "MEDIUM_RISK"),
                otherwise="LOW_RISK",
            ).alias("maintenance_risk"),
        )
    )


def oee(minutes: DataFrame, master: DataFrame, planned: DataFrame) -> DataFrame:
    """Availability, performance, quality and their product per machine-day, uncapped."""
    daily = _daily(minutes).groupBy("machine_id", "production_date").agg(
        F.sum("running_seconds").alias("_run"),
        F.sum("units_produced").alias("_units"),
        F.sum("good_units").alias("_good"),
    )
    rows = lookup(daily, master.select("machine_id", "ideal_cycle_time_sec"), "machine_id", "inner")
    rows = lookup(rows, planned, ["machine_id", "production_date"])
    run_min = num("_run") / 60
    ideal = num("ideal_cycle_time_sec") * num("_units")
    a = ratio(run_min, "planned_minutes")
    p = ratio(ideal, "_run")
    q = ratio("_good", "_units")
    return rows.select(
        "machine_id", "production_date", "planned_minutes",
        F.round(run_min, 2).alias("run_minutes"),
        F.round(a * 100, 2).alias("availability_pct"),
        F.round(p * 100, 2).alias("performance_pct"),
        F.round(q * 100, 2).alias("quality_pct"),
        F.round(a * p * q * 100, 2).alias("oee_pct"),
    )
