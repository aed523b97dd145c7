"""Sensor fact, one-minute indicators, hourly production fact and their roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.numeric import null_as_zero, num, ratio
from ..schemas import GAUGE
from .joins import as_of_version, lookup

READING_SECONDS = 5
GAUGES = ("temperature_c", "power_kw", "vibration_mm_s")


def conform(
    readings: DataFrame,
    machines: DataFrame,
    statuses: DataFrame,
    version: str = "as_of",
) -> DataFrame:
    """Attach every conformed key; an unresolved lookup becomes -1, never null.

    ``version`` picks the machine row valid at event time (``as_of``) or the
    current one (``current``). Loaded machines start at a fixed early date, so
    every reading falls into some version.
    """
    ts = F.col("event_time")
    out = readings.withColumns(
        {
            "event_date": F.to_date(ts),
            "date_key": keys.date_key(ts),
            "time_key": keys.time_key(ts),
            "flags_key": keys.flags_key(F.col("temperature_c")),
            **{g: F.col(g).cast(GAUGE) for g in GAUGES},
        }
    ).withColumn("shift_key", keys.shift_key(F.col("time_key")))
    wanted = ["machine_id", "machine_key", "ideal_cycle_time_sec", "valid_from", "valid_to", "is_current"]
    dim = machines.select(*wanted)
    if version == "as_of":
        out = as_of_version(out, dim, "machine_id", "event_time", reach_back=False)
    else:
        out = lookup(out, dim.where("is_current"), "machine_id")
    out = out.drop("valid_from", "valid_to", "is_current")
    status = statuses.where("status_key > 0").select(
        "status_key", "status_code", "is_productive", "is_downtime", "is_planned_downtime"
    )
    out = lookup(out, status, F.upper(F.col("status")) == F.col("status_code"))
    return out.withColumns(
        {
            "machine_key": keys.or_unknown(F.col("machine_key")),
            "status_key": keys.or_unknown(F.col("status_key")).cast("smallint"),
        }
    ).drop("status_code")


def sensor_fact(conformed: DataFrame, reading_seconds: float = READING_SECONDS) -> DataFrame:
    return conformed.select(
        "reading_id", "date_key", "time_key", "machine_key", "status_key", "shift_key", "flags_key",
        F.col("event_time").alias("event_ts"), "event_date", *GAUGES,
        null_as_zero("units_produced").alias("units_produced"),
        null_as_zero("good_units").alias("good_units"),
        F.lit(float(reading_seconds)).alias("runtime_seconds"),
    )


def _count_if(cond: str) -> str:
    return f"count(if({cond}, 1, NULL))"


# Additive parts of the hourly fact: name → aggregate over readings. All are sums,
# counts or maxima, so partial results combine and merge in any order.
def hourly_parts(reading_seconds: int = READING_SECONDS) -> dict[str, str]:
    seconds = lambda cond: f"{_count_if(cond)} * {int(reading_seconds)}"
    return {
        "reading_count": "count(*)",
        "units_produced": "cast(sum(coalesce(units_produced, 0)) AS bigint)",
        "good_units": "cast(sum(coalesce(good_units, 0)) AS bigint)",
        "runtime_seconds": seconds("is_productive"),
        "idle_seconds": seconds("upper(status) = 'IDLE'"),
        "downtime_seconds": seconds("is_downtime"),
        "planned_stop_seconds": seconds("is_planned_downtime"),
        "kw_seconds": f"sum(power_kw * {int(reading_seconds)})",
        "temp_sum": "sum(temperature_c)",
        "max_temperature_c": "max(temperature_c)",
        "vibration_sum": "sum(vibration_mm_s)",
        "vibration_count": "count(vibration_mm_s)",
        "max_vibration_mm_s": "max(vibration_mm_s)",
    }


ADDITIVE = (
    "reading_count", "units_produced", "good_units", "runtime_seconds", "idle_seconds",
    "downtime_seconds", "planned_stop_seconds", "kw_seconds", "temp_sum", "vibration_sum",
    "vibration_count",
)
MAXIMA = ("max_temperature_c", "max_vibration_mm_s")
GRAIN = ("machine_key", "window_start")


def hourly_components(conformed: DataFrame, reading_seconds: int = READING_SECONDS) -> DataFrame:
    return (
        conformed.withColumn("window_start", F.date_trunc("hour", "event_time"))
        .groupBy(*GRAIN)
        .agg(*[F.expr(text).alias(n) for n, text in hourly_parts(reading_seconds).items()])
    )


def merge_components(*parts: DataFrame) -> DataFrame:
    """Combine partial hourly rows of one grain: sums add, maxima compete."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*GRAIN).agg(
        *[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in ADDITIVE],
        *[F.max(c).alias(c) for c in MAXIMA],
    )


def finish_hourly(components: DataFrame, planned_minutes: float = 60.0) -> DataFrame:
    """Derived columns of the hourly fact; shifts start on the hour, so keys follow from it."""
    start = F.col("window_start")
    minute = F.hour(start) * 60
    return components.withColumns(
        {
            "window_end": start + F.expr("INTERVAL 1 HOUR"),
            "date_key": keys.date_key(start),
            "time_key": minute.cast("smallint"),
            "shift_key": keys.shift_key(minute),
            "scrap_units": F.col("units_produced") - F.col("good_units"),
            "runtime_minutes": num("runtime_seconds") / 60,
            "idle_minutes": num("idle_seconds") / 60,
            "downtime_minutes": num("downtime_seconds") / 60,
            "planned_minutes": F.lit(planned_minutes),
            "planned_stop_minutes": num("planned_stop_seconds") / 60,
            "energy_kwh": num("kw_seconds") / 3600,
            "avg_temperature_c": ratio("temp_sum", "reading_count"),
            "avg_vibration_mm_s": ratio("vibration_sum", "vibration_count"),
        }
    )


def hourly_fact(conformed: DataFrame, reading_seconds: int = READING_SECONDS) -> DataFrame:
    return finish_hourly(hourly_components(conformed, reading_seconds))


# Aggregates of the one-minute indicators; batch and stream share them.
MINUTE_AGGREGATES = {
    "reading_count": "count(*)",
    "temp_sum": "sum(temperature_c)",
    "avg_temperature_c": "cast(sum(temperature_c) AS double) / nullif(count(temperature_c), 0)",
    "max_temperature_c": "max(temperature_c)",
    "avg_power_kw": "cast(sum(power_kw) AS double) / nullif(count(power_kw), 0)",
    "total_power_kwh": "cast(sum(power_kw) AS double) / 60",
    "running_seconds": _count_if("status = 'RUNNING'"),
    "idle_seconds": _count_if("status = 'IDLE'"),
    "down_seconds": _count_if("status IN ('DOWN', 'FAULT')"),
    "units_produced": "cast(sum(units_produced) AS bigint)",
    "good_units": "cast(sum(good_units) AS bigint)",
    "power_sum": "sum(power_kw)",
}


def minute_kpis(readings: DataFrame) -> DataFrame:
    """One row per machine and minute. Works on a batch or a watermarked stream."""
    return (
        readings.groupBy("machine_id", F.window("event_time", "1 minute").alias("w"))
        .agg(*[F.expr(text).alias(n) for n, text in MINUTE_AGGREGATES.items()])
        .select(
            "machine_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *MINUTE_AGGREGATES,
        )
    )


def rollup_minutes(
    minutes: DataFrame, machines: DataFrame, planned: DataFrame, daily_share: bool = False
) -> DataFrame:
    """Hourly rows from one-minute rows, with planned minutes per machine and date.

    ``daily_share`` spreads the daily plan over 24 hours, the older reading of it;
    otherwise a planned hour counts 60 minutes.
    """
    hour = F.date_trunc("hour", "window_start")
    dim = machines.where("is_current").select("machine_id", "machine_key")
    base = lookup(minutes, dim, "machine_id").withColumns(
        {
            "machine_key": keys.or_unknown(F.col("machine_key")),
            "hour_start": hour,
            "production_date": F.to_date("window_start"),
        }
    )
    agg = base.groupBy("machine_key", "machine_id", "production_date", "hour_start").agg(
        F.count("*").alias("minute_count"),
        F.sum("reading_count").alias("reading_count"),
        F.sum(null_as_zero("units_produced")).alias("units_produced"),
        F.sum(null_as_zero("good_units")).alias("good_units"),
        F.sum("running_seconds").alias("running_seconds"),
        F.sum("idle_seconds").alias("idle_seconds"),
        F.sum("down_seconds").alias("down_seconds"),
        F.sum("power_sum").alias("power_sum"),
        F.sum("temp_sum").alias("temp_sum"),
        F.max("max_temperature_c").alias("max_temperature_c"),
    )
    # The plan is joined after the aggregate: one row per machine-hour, not per minute.
    planned_cols = planned.select("machine_id", "production_date", F.col("planned_minutes").alias("_day_plan"))
    joined = lookup(agg, planned_cols, ["machine_id", "production_date"])
    share = F.coalesce(num("_day_plan") / 24, F.lit(60.0)) if daily_share else F.lit(60.0)
    minute = F.hour("hour_start") * 60
    return joined.select(
        "machine_key", "machine_id",
        F.col("hour_start").alias("window_start"),
        (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        keys.date_key(F.col("hour_start")).alias("date_key"),
        minute.cast("smallint").alias("time_key"),
        keys.shift_key(minute).alias("shift_key"),
        "minute_count", "reading_count", "units_produced", "good_units",
        (F.col("units_produced") - F.col("good_units")).alias("scrap_units"),
        (num("running_seconds") / 60).alias("runtime_minutes"),
        (num("idle_seconds") / 60).alias("idle_minutes"),
        (num("down_seconds") / 60).alias("downtime_minutes"),
        share.alias("planned_minutes"),
        (num("power_sum") / 60).alias("energy_kwh"),
        ratio("temp_sum", "reading_count").alias("avg_temperature_c"),
        "max_temperature_c",
        num("temp_sum").alias("temp_sum"),
    )
