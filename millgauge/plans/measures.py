"""Named measures over the star.

A measure is an expression over additive components. The components are summed
at the grain the caller asks for, then every ratio is computed once at that
grain; a percentage is never averaged. Each fact is aggregated on its own and
the small results meet in a full outer join on the group columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import oee_colour
from ..functions.numeric import num, ratio
from ..operators.joins import lookup

OEE_TARGET = 0.85
TARIFF = 0.14
MACHINE_ATTRIBUTES = ("machine_key", "machine_id", "machine_name", "machine_type", "production_line", "plant_code")

# ---- components -------------------------------------------------------------
PRODUCTION_SUMS = {
    "c_readings": "count(*)",
    "c_units": "cast(sum(units_produced) AS bigint)",
    "c_good": "cast(sum(good_units) AS bigint)",
    "c_scrap": "cast(sum(scrap_units) AS bigint)",
    "c_runtime_s": "sum(runtime_seconds)",
    "c_idle_s": "sum(idle_seconds)",
    "c_downtime_s": "sum(downtime_seconds)",
    "c_planned_stop_s": "sum(planned_stop_seconds)",
    "c_planned_min": "sum(planned_minutes)",
    "c_kw_seconds": "sum(kw_seconds)",
    "c_temp_sum": "sum(temp_sum)",
    "c_reading_count": "sum(reading_count)",
    "c_ideal_seconds": "sum(units_produced * ideal_cycle_time_sec)",
    "c_max_temp": "max(max_temperature_c)",
    "c_avg_vibration": "cast(sum(cast(avg_vibration_mm_s AS decimal(20,9))) AS double) / nullif(count(avg_vibration_mm_s), 0)",
    "c_last_end": "max(window_end)",
    "c_machines": "count(DISTINCT machine_key)",
}


def production_sums() -> dict[str, Column]:
    return {name: F.expr(text) for name, text in PRODUCTION_SUMS.items()}


# Parts that add up over disjoint groups, so windows over dates may sum them.
WINDOW_PARTS = (
    "c_units", "c_good", "c_scrap", "c_runtime_s", "c_idle_s", "c_downtime_s", "c_planned_stop_s",
    "c_planned_min", "c_ideal_seconds",
)


def window_components(fact: DataFrame, group: Sequence[str]) -> DataFrame:
    """Only the parts that time windows need; ``fact`` carries its ideal cycle time."""
    known = production_sums()
    return fact.groupBy(*group).agg(*[known[p].alias(p) for p in WINDOW_PARTS])


def production_components(hourly: DataFrame, machines: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sums of the hourly fact at the requested grain; the machine dimension is joined
    once for group columns and ideal cycle time."""
    ready = set(hourly.columns)
    extra = [c for c in MACHINE_ATTRIBUTES if c in group and c not in ready]
    rows = hourly
    if "ideal_cycle_time_sec" not in ready or extra:
        wanted = ["machine_key", *extra] + ([] if "ideal_cycle_time_sec" in ready else ["ideal_cycle_time_sec"])
        rows = lookup(hourly, machines.select(*wanted), "machine_key")
    return rows.groupBy(*group).agg(*[c.alias(n) for n, c in production_sums().items()])


def downtime_components(downtime: DataFrame, group: Sequence[str]) -> DataFrame:
    minutes = F.col("duration_minutes").cast("decimal(18,2)")
    return downtime.groupBy(*group).agg(
        F.count("*").alias("c_stops"),
        num(F.sum(minutes)).alias("c_stop_minutes"),
        F.count_if("is_open").alias("c_open_stops"),
        num(F.sum(F.when(~F.col("is_planned"), minutes))).alias("c_unplanned_minutes"),
    )


def alert_components(alerts: DataFrame, alert_types: DataFrame, group: Sequence[str]) -> DataFrame:
    dim = alert_types.select("alert_type_key", F.col("severity").alias("_severity"))
    rows = lookup(alerts, dim, "alert_type_key")
    return rows.groupBy(*group).agg(
        F.sum("alert_count").alias("c_alerts"),
        F.sum(F.when(F.col("is_open"), F.col("alert_count"))).alias("c_active_alerts"),
        F.sum(F.when(F.col("_severity") == "CRITICAL", F.col("alert_count"))).alias("c_critical_alerts"),
        num(F.sum(F.col("time_to_acknowledge_min").cast("decimal(18,4)"))).alias("c_ack_minutes"),
        F.count("time_to_acknowledge_min").alias("c_acked"),
        F.count("acknowledged_at").alias("c_acknowledged"),
        F.count_if(~F.col("breached_sla")).alias("c_in_sla"),
        F.max("raised_at").alias("c_newest_alert"),
    )


def member_components(machines: DataFrame, group: Sequence[str]) -> DataFrame | None:
    """Plain averages over the machine members in context: grouped by the machine
    attributes among the group columns, over all members when there are none."""
    attrs = [c for c in group if c in MACHINE_ATTRIBUTES]
    return machines.where("is_current").groupBy(*attrs).agg(
        ratio(F.sum("ideal_cycle_time_sec"), F.count("ideal_cycle_time_sec")).alias("c_mean_ideal"),
        ratio(F.sum("rated_power_kw"), F.count("rated_power_kw")).alias("c_mean_rated_kw"),
    )


# ---- measures ---------------------------------------------------------------
def availability() -> Column:
    """Runtime over planned time without planned stops, at most 1."""
    usable = num("c_planned_min") - num("c_planned_stop_s") / 60
    return F.least(F.try_divide(num("c_runtime_s") / 60, usable), F.lit(1.0))


def availability_all_stops() -> Column:
    """Variant without a cap that takes every stop as planned."""
    return F.try_divide(num("c_runtime_s") / 60, num("c_planned_min") - num("c_downtime_s") / 60)


def performance() -> Column:
    return F.least(ratio("c_ideal_seconds", "c_runtime_s"), F.lit(1.0))


def quality() -> Column:
    return ratio("c_good", "c_units")


def oee() -> Column:
    return availability() * performance() * quality()


def energy_kwh() -> Column:
    return num("c_kw_seconds") / 3600


def mtbf_hours() -> Column:
    return F.try_divide(num("c_runtime_s") / 60, num("c_stops")) / 60


def mttr_hours() -> Column:
    return ratio("c_stop_minutes", "c_stops") / 60


def catalogue() -> dict[str, Callable[[], Column]]:
    """Every measure by name; an expression is built only when it is asked for."""
    return {
        "total_readings": lambda: F.col("c_readings"),
        "total_units": lambda: F.col("c_units"),
        "total_good_units": lambda: F.col("c_good"),
        "total_scrap_units": lambda: F.col("c_scrap"),
        "total_runtime_min": lambda: num("c_runtime_s") / 60,
        "total_idle_min": lambda: num("c_idle_s") / 60,
        "total_downtime_min": lambda: num("c_downtime_s") / 60,
        "total_planned_min": lambda: num("c_planned_min"),
        "avg_temperature_c": lambda: ratio("c_temp_sum", "c_reading_count"),
        "max_temperature_c": lambda: num("c_max_temp"),
        "avg_vibration_mm_s": lambda: F.col("c_avg_vibration"),
        "availability": availability,
        "availability_all_stops": availability_all_stops,
        "performance": performance,
        "quality": quality,
        "oee": oee,
        "oee_target": lambda: F.lit(OEE_TARGET),
        "oee_vs_target": lambda: oee() - OEE_TARGET,
        "oee_gap_units": lambda: ratio("c_runtime_s", "c_mean_ideal") - num("c_units"),
        "availability_loss_min": lambda: num("c_planned_min") - num("c_planned_stop_s") / 60 - num("c_runtime_s") / 60,
        "performance_loss_min": lambda: num("c_runtime_s") / 60 * (1 - performance()),
        "quality_loss_min": lambda: num("c_scrap") * F.col("c_mean_ideal") / 60,
        "scrap_rate": lambda: ratio("c_scrap", "c_units"),
        "first_pass_yield": quality,
        "defects_per_million": lambda: ratio("c_scrap", "c_units") * 1000000,
        "downtime_events": lambda: F.coalesce("c_stops", F.lit(0)),
        "mtbf_hours": mtbf_hours,
        "mttr_hours": mttr_hours,
        "technical_availability": lambda: ratio(mtbf_hours(), mtbf_hours() + mttr_hours()),
        "open_downtime_events": lambda: F.coalesce("c_open_stops", F.lit(0)),
        "unplanned_downtime_min": lambda: F.col("c_unplanned_minutes"),
        "total_alerts": lambda: F.col("c_alerts"),
        "active_alerts": lambda: F.col("c_active_alerts"),
        "critical_alerts": lambda: F.col("c_critical_alerts"),
        "mtta_min": lambda: ratio("c_ack_minutes", "c_acked"),
        "sla_compliance": lambda: ratio("c_in_sla", "c_acknowledged"),
        "alerts_per_1k_units": lambda: ratio("c_alerts", "c_units") * 1000,
        "total_energy_kwh": energy_kwh,
        "energy_per_unit_kwh": lambda: ratio(energy_kwh(), "c_units"),
        "energy_cost": lambda: energy_kwh() * TARIFF,
        "energy_intensity_vs_rated": lambda: ratio(
            F.try_divide(energy_kwh() * 60, num("c_runtime_s") / 60), "c_mean_rated_kw"
        ),
        "oee_status_colour": lambda: oee_colour(oee()),
        "selected_machines": lambda: F.col("c_machines"),
        "last_refresh": lambda: F.col("c_last_end"),
    }


_NEEDS_STOPS = {"downtime_events", "mtbf_hours", "mttr_hours", "technical_availability",
                "open_downtime_events", "unplanned_downtime_min"}
_NEEDS_ALERTS = {"total_alerts", "active_alerts", "critical_alerts", "mtta_min", "sla_compliance",
                 "alerts_per_1k_units"}
_NEEDS_MEMBERS = {"oee_gap_units", "quality_loss_min", "energy_intensity_vs_rated"}


def _with_group(fact: DataFrame, machines: DataFrame, group: Sequence[str]) -> DataFrame:
    """Machine attributes always come from the dimension, so every fact groups alike."""
    wanted = [g for g in group if g in MACHINE_ATTRIBUTES and g != "machine_key"]
    return lookup(fact.drop(*wanted), machines.select("machine_key", *wanted), "machine_key") if wanted else fact


def _meet(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Full outer join of two aggregates on null-safe group columns."""
    if not group:
        return left.crossJoin(right)  # one row each
    r = right.select(*[F.col(g).alias(f"_r_{g}") for g in group], *[x for x in right.columns if x not in group])
    cond = F.lit(True)
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_r_{g}"))
    joined = left.join(r, cond, "full")
    return joined.select(
        *[F.coalesce(F.col(g), F.col(f"_r_{g}")).alias(g) for g in group],
        *[x for x in left.columns if x not in group],
        *[x for x in right.columns if x not in group],
    )


def measures(star, names: Sequence[str], group: Sequence[str] = (), facts: dict | None = None) -> DataFrame:
    """Named measures at the grain of ``group``. Only the facts that the names need are read.

    ``star`` gives hourly, downtime, alerts, machines and alert_types; ``facts``
    overrides any of them, for instance with scoped rows.
    """
    get = lambda name: (facts or {}).get(name, getattr(star, name, None))
    machines, group = get("machines"), list(group)
    parts = production_components(get("hourly"), machines, group)
    if _NEEDS_STOPS & set(names):
        rows = _with_group(get("downtime"), machines, group)
        parts = _meet(parts, downtime_components(rows, group), group)
    if _NEEDS_ALERTS & set(names):
        rows = _with_group(get("alerts"), machines, group)
        parts = _meet(parts, alert_components(rows, get("alert_types"), group), group)
    if _NEEDS_MEMBERS & set(names):
        members = member_components(machines, group)
        attrs = [g for g in group if g in MACHINE_ATTRIBUTES]
        parts = lookup(parts, members, attrs) if attrs else parts.crossJoin(members)
    known = catalogue()
    return parts.select(*group, *[known[n]().alias(n) for n in names])


def theoretical_minutes_per_machine(hourly: DataFrame, machines: DataFrame, group: Sequence[str]) -> DataFrame:
    """Two-level form of the performance numerator: per machine first, then the target grain."""
    per_machine = hourly.groupBy("machine_key", *group).agg(F.sum("units_produced").alias("units"))
    rows = lookup(per_machine, machines.select("machine_key", "ideal_cycle_time_sec"), "machine_key")
    return rows.groupBy(*group).agg(
        (num(F.sum(F.col("units") * F.col("ideal_cycle_time_sec"))) / 60).alias("theoretical_min")
    )


def alerts_last_day(alerts: DataFrame) -> DataFrame:
    """Alerts within a day of the newest one."""
    newest = alerts.agg(F.max("raised_at").alias("_newest"))
    return (
        alerts.crossJoin(F.broadcast(newest))
        .where(F.col("raised_at") >= F.col("_newest") - F.expr("INTERVAL 1 DAY"))
        .agg(F.sum("alert_count").alias("alerts_last_24h"))
    )


def waterfall(table: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Measures as (measure, value) rows: loss waterfall and measure picker."""
    return table.unpivot(list(keep), [F.col(n).cast("double").alias(n) for n in names], "measure", "value")
