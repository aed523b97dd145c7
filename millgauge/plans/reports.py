"""Datasets behind the report pages; drawing is out of scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import num, steady_mean, steady_sum
from ..operators.joins import lookup
from ..operators.sequence import newest_per
from . import kpis, timeintel
from .measures import measures, oee, waterfall

OVERVIEW = ("oee", "availability", "performance", "quality", "active_alerts", "avg_temperature_c",
            "total_downtime_min", "energy_per_unit_kwh")
OEE_PARTS = ("oee", "availability", "performance", "quality")
LOSSES = ("availability_loss_min", "performance_loss_min", "quality_loss_min")
PICKER = (*OEE_PARTS, "scrap_rate")


def _by_date(star) -> dict[str, DataFrame]:
    day = lambda df, ts: df.withColumn("full_date", F.to_date(ts))
    return {
        "hourly": day(star.hourly, "window_start"),
        "alerts": day(star.alerts, "raised_at"),
        "downtime": day(star.downtime, "started_at"),
    }


def overview(star) -> DataFrame:
    return measures(star, OVERVIEW)


def oee_trend(star, as_of: Column | None = None) -> DataFrame:
    """OEE by date against its target; dates after the reference day are left out."""
    out = measures(star, ("oee", "oee_target"), ("full_date",), _by_date(star))
    return out.where(F.col("full_date") <= F.to_date(as_of)) if as_of is not None else out


def machine_table(star) -> DataFrame:
    table = measures(star, ("avg_temperature_c", "oee", "active_alerts"), ("machine_id",))
    last = newest_per(star.readings.select("machine_id", "event_time", "reading_id", "status"),
                      ["machine_id"], ["event_time", "reading_id"])
    named = star.statuses.select(F.col("status_code").alias("_code"), "status_name", "display_colour_hex")
    last = lookup(last, named, F.upper("status") == F.col("_code")).select(
        "machine_id", "status_name", "display_colour_hex"
    )
    return table.join(last, "machine_id", "left")


def oee_by_machine(star) -> DataFrame:
    return measures(star, OEE_PARTS, ("machine_name",)).orderBy(F.desc("oee"), "machine_name")


def units_by_date(star) -> DataFrame:
    return measures(star, ("total_units", "oee"), ("full_date",), _by_date(star))


def shift_matrix(star, machine_ids: list[str]) -> DataFrame:
    """OEE with one row per shift and one column per listed machine."""
    cells = measures(star, ("oee",), ("shift_key", "machine_id"))
    named = lookup(cells, star.shifts.select("shift_key", "shift_name"), "shift_key")
    return named.groupBy("shift_name").pivot("machine_id", machine_ids).agg(F.max("oee"))


def oee_by_shift(star) -> DataFrame:
    cells = measures(star, ("oee", "total_units"), ("shift_key",))
    return lookup(cells, star.shifts.select("shift_key", "shift_name"), "shift_key")


def energy_by_date(star) -> DataFrame:
    return measures(star, ("total_energy_kwh",), ("full_date", "machine_id"), _by_date(star))


def energy_per_unit(star) -> DataFrame:
    return measures(star, ("total_energy_kwh", "energy_per_unit_kwh"), ("machine_id",))


def loss_waterfall(star) -> DataFrame:
    return waterfall(measures(star, LOSSES, ("machine_id",)), LOSSES, ["machine_id"])


def measure_picker(star) -> DataFrame:
    return waterfall(measures(star, PICKER, ("machine_id",)), PICKER, ["machine_id"])


def reliability(star) -> DataFrame:
    return measures(star, ("mtbf_hours", "mttr_hours", "sla_compliance", "open_downtime_events"))


def alert_log(star) -> DataFrame:
    rows = lookup(star.alerts, star.machines.select("machine_key", "machine_name"), "machine_key")
    rows = lookup(rows, star.alert_types.select("alert_type_key", "alert_name", "severity"), "alert_type_key")
    return rows.select(
        "reading_id", "raised_at", "machine_name", "alert_name", "severity",
        F.col("time_to_acknowledge_min").alias("mtta_min"), "breached_sla",
    ).orderBy(F.desc("raised_at"), "reading_id", "alert_name")


def alerts_by_date(star) -> DataFrame:
    rows = lookup(star.alerts, star.alert_types.select("alert_type_key", "severity"), "alert_type_key")
    return rows.groupBy(F.to_date("raised_at").alias("full_date"), "severity").agg(
        F.sum("alert_count").alias("total_alerts")
    )


def downtime_by_plan(star) -> DataFrame:
    return star.downtime.groupBy("machine_id", "is_planned").agg(
        F.count("*").alias("stops"),
        num(F.sum(F.col("duration_minutes").cast("decimal(18,2)"))).alias("downtime_min"),
    )


def reliability_quadrant(star) -> DataFrame:
    """MTBF, MTTR and stop minutes per machine and month."""
    month = lambda df, ts: df.withColumn("month_start", F.to_date(F.date_trunc("month", ts)))
    return measures(
        star, ("mtbf_hours", "mttr_hours", "total_downtime_min"), ("machine_id", "month_start"),
        {"hourly": month(star.hourly, "window_start"), "downtime": month(star.downtime, "started_at")},
    )


def downtime_drill(star) -> DataFrame:
    """Stop minutes rolled up machine → shift → status, with the level of each row."""
    return (
        star.downtime.withColumn("_m", F.col("duration_minutes").cast("decimal(18,2)"))
        .rollup("machine_id", "shift_key", "reason_code")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count("*").alias("stops"),
            num(F.sum("_m")).alias("downtime_min"),
        )
    )


def line_drill(star) -> DataFrame:
    """Units rolled up plant → line → machine."""
    rows = lookup(star.hourly, star.machines.select("machine_key", "plant_code", "production_line", "machine_id"),
                  "machine_key")
    return rows.rollup("plant_code", "production_line", "machine_id").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("units_produced").cast("bigint").alias("units"),
    )


def machine_detail(star, machine_id: str) -> DataFrame:
    """Trace, alerts and stops of one machine as one timeline. The filter reaches the scan."""
    trace = star.conformed.where(F.col("machine_id") == machine_id).select(
        F.lit("reading").alias("kind"), F.col("event_time").alias("at"),
        F.upper("status").alias("label"), num("temperature_c").alias("value"),
    )
    key = star.machines.where(F.col("machine_id") == machine_id).select("machine_key")
    raised = lookup(star.alerts, star.alert_types.select("alert_type_key", "alert_code"), "alert_type_key").join(
        F.broadcast(key), "machine_key", "left_semi"
    ).select(F.lit("alert").alias("kind"), F.col("raised_at").alias("at"),
             F.col("alert_code").alias("label"), F.col("trigger_value").alias("value"))
    stops = star.downtime.where(F.col("machine_id") == machine_id).select(
        F.lit("stop").alias("kind"), F.col("started_at").alias("at"),
        F.col("reason_code").alias("label"), F.col("duration_minutes").alias("value"),
    )
    return trace.unionByName(raised).unionByName(stops)


def machine_tooltip(star) -> DataFrame:
    """OEE per hour of the last day, with open alerts, per machine."""
    newest = star.readings.agg(F.max("event_time").alias("_newest"))
    last_day = star.hourly.crossJoin(F.broadcast(newest)).where(
        F.col("window_end") > F.col("_newest") - F.expr("INTERVAL 24 HOURS")
    ).drop("_newest")
    series = measures(star, ("oee",), ("machine_id", "window_start"), {"hourly": last_day})
    open_alerts = measures(star, ("active_alerts",), ("machine_id",))
    return series.join(open_alerts, "machine_id", "left")


def first_generation_page(star) -> DataFrame:
    """Per machine: mean OEE parts, mean utilisation, summed energy and stops of the views."""
    views = kpis.oee(star.minute_kpis, star.master, star.planned_time)
    mean = lambda col: steady_mean(col, 2).alias(col)
    parts = views.groupBy("machine_id").agg(
        *[mean(x) for x in ("availability_pct", "performance_pct", "quality_pct", "oee_pct")]
    )
    use = kpis.utilization(star.minute_kpis).groupBy("machine_id").agg(mean("utilization_pct"))
    power = kpis.power_consumption(star.minute_kpis).groupBy("machine_id").agg(
        steady_sum("total_kwh").alias("total_kwh")
    )
    stops = kpis.downtime(star.downtime_events).groupBy("machine_id").agg(
        steady_sum("total_downtime_minutes", 2).alias("total_downtime_minutes")
    )
    return parts.join(use, "machine_id").join(power, "machine_id").join(stops, "machine_id", "left")


def monthly_oee(daily: DataFrame, date: str) -> DataFrame:
    """OEE by month with the month before and the change on it."""
    months = timeintel.monthly(daily, date).withColumn("oee", oee())
    out = timeintel.previous_month(months.select("month_start", "oee"), "oee", "oee_pm")
    return out.withColumn("oee_mom", timeintel.growth(F.col("oee"), F.col("oee_pm")))
