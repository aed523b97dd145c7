"""Alert rules, suppression of repeats, service-level evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import minutes_between
from .joins import lookup
from .sequence import gap_starts

TEMPERATURE_LIMIT_C = 85
VIBRATION_LIMIT = 4.5
EXCLUSIVE_VIBRATION_LIMIT = 5.0
REARM_MINUTES = 5


def matched_rules(temperature: float = TEMPERATURE_LIMIT_C, vibration: float = VIBRATION_LIMIT) -> Column:
    """Array of the independent rules a reading breaks, with trigger and threshold."""

    def rule(broken: Column, code: str, trigger: str, threshold: float | None) -> Column:
        row = F.struct(
            F.lit(code).alias("alert_code"),
            F.col(trigger).cast("double").alias("trigger_value"),
            F.lit(threshold).cast("double").alias("threshold_value"),
        )
        return F.when(broken, row)

    return F.array_compact(
        F.array(
            rule(F.upper("status").isin("FAULT", "DOWN"), "FAULT_STATUS", "temperature_c", None),
            rule(F.col("temperature_c") > temperature, "HIGH_TEMP", "temperature_c", temperature),
            rule(F.col("vibration_mm_s") > vibration, "HIGH_VIBRATION", "vibration_mm_s", vibration),
        )
    )


def candidates(readings: DataFrame, **limits: float) -> DataFrame:
    """One row per reading and broken rule, in a single pass over the readings."""
    return readings.withColumn("_r", F.explode(matched_rules(**limits))).select(
        *readings.columns, "_r.alert_code", "_r.trigger_value", "_r.threshold_value"
    )


def exclusive_alerts(
    readings: DataFrame,
    temperature: float = TEMPERATURE_LIMIT_C,
    vibration: float = EXCLUSIVE_VIBRATION_LIMIT,
) -> DataFrame:
    """First broken rule only: fault, then temperature, then vibration; one row per reading."""
    hot = F.col("temperature_c") >= temperature
    shaky = F.col("vibration_mm_s") >= vibration
    pick = (
        F.when(F.col("status") == "FAULT", F.struct(
            F.lit("FAULT_STATUS").alias("alert_type"), F.lit("CRITICAL").alias("severity"),
            F.concat(F.lit("Machine "), F.col("machine_id"), F.lit(" reported FAULT status")).alias("message")))
        .when(hot, F.struct(
            F.lit("HIGH_TEMP").alias("alert_type"), F.lit("HIGH").alias("severity"),
            F.concat(F.lit("Temperature "), F.col("temperature_c"), F.lit("C exceeds threshold")).alias("message")))
        .when(shaky, F.struct(
            F.lit("HIGH_VIBRATION").alias("alert_type"), F.lit("MEDIUM").alias("severity"),
            F.concat(F.lit("Vibration "), F.col("vibration_mm_s"), F.lit("mm/s exceeds threshold")).alias("message")))
    )
    return (
        readings.withColumn("_a", pick)
        .where(F.col("_a").isNotNull())
        .select(F.col("reading_id").alias("alert_id"), "machine_id", "event_time", "_a.*")
    )


def occurrences(alerts: DataFrame, keys: list[str], ts: str, ties: list[str], gap_minutes: float) -> DataFrame:
    """Keep an alert only when its key has been quiet for longer than the gap."""
    return gap_starts(alerts, keys, ts, ties, gap_minutes * 60)


def alert_fact(cands: DataFrame, alert_types: DataFrame) -> DataFrame:
    """Candidates in fact shape; an unlisted code gets the Unknown member."""
    dim = alert_types.select("alert_type_key", F.col("alert_code").alias("_code"))
    out = lookup(cands, dim, F.col("alert_code") == F.col("_code"))
    return out.select(
        "reading_id", "date_key", "time_key", "machine_key",
        F.coalesce("alert_type_key", F.lit(-1)).cast("smallint").alias("alert_type_key"),
        "shift_key",
        F.col("event_time").alias("raised_at"),
        F.lit(1).alias("alert_count"),
        "trigger_value", "threshold_value",
        F.concat(F.lit("Machine "), F.col("machine_id"), F.lit(" raised "), F.col("alert_code")).alias("message"),
    )


def raise_alerts(
    conformed: DataFrame, alert_types: DataFrame, rearm_minutes: float = REARM_MINUTES, **limits: float
) -> DataFrame:
    """Batch form over any span of time: transition-grained alerts per machine and rule."""
    cands = candidates(conformed, **limits)
    kept = occurrences(cands, ["machine_id", "alert_code"], "event_time", ["reading_id"], rearm_minutes)
    return alert_fact(kept.drop("_prev_ts"), alert_types)


def open_alerts(fact: DataFrame, as_of: Column, rearm_minutes: float = REARM_MINUTES) -> DataFrame:
    """Keys raised inside the re-arm window before ``as_of``."""
    recent = F.col("raised_at") > as_of - F.expr(f"INTERVAL {int(rearm_minutes * 60)} SECONDS")
    return fact.where(recent).select("machine_key", "alert_type_key").distinct()


def emit_batch(
    conformed: DataFrame,
    alert_types: DataFrame,
    existing: DataFrame,
    rearm_minutes: float = REARM_MINUTES,
    **limits: float,
) -> DataFrame:
    """Micro-batch form: the alerts of ``raise_alerts``, less those with an existing one
    within the re-arm time before. Event time decides, so catch-up behaves like live.

    The message names machine and rule; existing rows that have one are compared by it, which tells
    unknown machines apart."""
    new = raise_alerts(conformed, alert_types, rearm_minutes, **limits)
    raised = existing.select("machine_key", "alert_type_key", F.col("raised_at").alias("_raised"),
                             (F.col("message") if "message" in existing.columns else F.lit(None).cast("string")).alias("_message"))
    hit = (
        (new["machine_key"] == raised["machine_key"])
        & (new["alert_type_key"] == raised["alert_type_key"])
        & (F.col("_message").isNull() | (F.col("_message") == F.col("message")))
        & (F.col("_raised") <= F.col("raised_at"))
        & (F.col("_raised") > F.col("raised_at") - F.expr(f"INTERVAL {int(rearm_minutes * 60)} SECONDS"))
    )
    return new.join(raised, hit, "left_anti")


def evaluate_sla(fact: DataFrame, alert_types: DataFrame) -> DataFrame:
    """Minutes to acknowledge and resolve, and whether the response target was missed.

    Rows never acknowledged keep nulls.
    """
    dim = alert_types.select("alert_type_key", F.col("sla_response_minutes").alias("_sla"))
    ack = F.col("acknowledged_at").isNotNull()
    to_ack = minutes_between(F.col("raised_at"), F.col("acknowledged_at"))
    to_fix = minutes_between(F.col("raised_at"), F.col("resolved_at"))
    return (
        lookup(fact, dim, "alert_type_key")
        .withColumns(
            {
                "time_to_acknowledge_min": F.when(ack, to_ack),
                "time_to_resolve_min": F.when(ack, to_fix),
                "breached_sla": F.when(ack, to_ack > F.col("_sla")),
                "is_open": F.col("resolved_at").isNull(),
            }
        )
        .drop("_sla")
    )
