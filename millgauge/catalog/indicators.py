"""Indicator views, measures and time intelligence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import trend
from ..functions.numeric import steady_mean, steady_sum
from ..plans import kpis, reports, timeintel
from ..plans.measures import WINDOW_PARTS, alerts_last_day, measures, oee, window_components
from ..sources import tables
from .registry import Context, query
from .sql import A, OEE, P, Q, alert_parts, line_oee, mean, parts, stop_parts, total

# ---- views ------------------------------------------------------------------
LIVE_SQL = """SELECT m.machine_id, machine_name, machine_type, location, status, event_time AS last_event_time,
  CAST(temperature_c AS DOUBLE) AS temperature_c, CAST(power_kw AS DOUBLE) AS power_kw,
  CASE WHEN event_time >= as_of - INTERVAL 5 MINUTE THEN 'ONLINE' ELSE 'OFFLINE' END AS connectivity
FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_time DESC, reading_id DESC) AS rn FROM readings) r
JOIN master m ON m.machine_id = r.machine_id, newest WHERE rn = 1"""


def live(x):
    return kpis.live_status(x.facts.readings, x.facts.master)


query("kpi1", LIVE_SQL)(live)

TEMP_SQL = """SELECT machine_id, CAST(sum(temperature_c) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR) AS DOUBLE) / count(*) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR) AS avg_temp_last_1h,
  CAST(sum(temperature_c) FILTER (WHERE event_time >= as_of - INTERVAL 24 HOUR) AS DOUBLE) / count(*) FILTER (WHERE event_time >= as_of - INTERVAL 24 HOUR) AS avg_temp_last_24h,
  CAST(max(temperature_c) FILTER (WHERE event_time >= as_of - INTERVAL 24 HOUR) AS DOUBLE) AS max_temp_last_24h FROM readings, newest GROUP BY ALL"""
TEMP_SQL = TEMP_SQL.replace("/ count(*)", "/ nullif(count(*)").replace(" AS avg_temp", ", 0) AS avg_temp")


def temperature(x):
    return kpis.average_temperature(x.facts.readings, x.facts.newest_reading, x.facts.machine_ids)


query("kpi2", TEMP_SQL)(temperature)

ALERT_SQL = """SELECT f.alert_id, f.machine_id, machine_name, event_time, alert_type, severity, message, acknowledged
FROM failure_alerts f JOIN master m ON m.machine_id = f.machine_id"""


def alert_view(x):
    return kpis.failure_alerts(x.facts.failure_alerts, x.facts.master)


query("kpi3", ALERT_SQL + " ORDER BY event_time DESC")(alert_view)

UTIL_SQL = """SELECT machine_id, CAST(window_start AS DATE) AS production_date, CAST(sum(running_seconds) AS BIGINT) AS running_seconds, CAST(sum(idle_seconds) AS BIGINT) AS idle_seconds,
  CAST(sum(down_seconds) AS BIGINT) AS down_seconds, CAST(sum(running_seconds + idle_seconds + down_seconds) AS BIGINT) AS total_seconds,
  round(CAST(100 * sum(running_seconds) AS DOUBLE) / nullif(CAST(sum(running_seconds + idle_seconds + down_seconds) AS DOUBLE), 0), 2) AS utilization_pct
FROM minutes GROUP BY ALL"""


def utilization(x):
    return kpis.utilization(x.facts.minute_kpis)


query("kpi4", UTIL_SQL)(utilization)

POWER_SQL = f"""SELECT machine_id, CAST(window_start AS DATE) AS production_date, CAST(sum(power_sum) AS DOUBLE) / 60 AS total_kwh, {mean('avg_power_kw')} AS avg_kw FROM minutes GROUP BY ALL"""


def power(x):
    return kpis.power_consumption(x.facts.minute_kpis)


query("kpi5", POWER_SQL)(power)

DOWN_SQL = """SELECT machine_id, CAST(start_time AS DATE) AS production_date, count(*) AS downtime_events,
  CAST(sum(CAST(coalesce(duration_minutes, 0) AS DECIMAL(18,2))) AS DOUBLE) AS total_downtime_minutes,
  CAST(sum(CAST(coalesce(duration_minutes, 0) AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_downtime_minutes FROM downtime_events GROUP BY ALL"""


def downtime(x):
    return kpis.downtime(x.facts.downtime_events)


query("kpi6", DOWN_SQL)(downtime)


@query("kpi7", """WITH mean AS (SELECT machine_id,
  CAST(sum(temperature_c) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR) AS DOUBLE) / nullif(count(*) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR), 0) AS temp_1h,
  CAST(sum(temperature_c) FILTER (WHERE event_time >= as_of - INTERVAL 6 HOUR) AS DOUBLE) / nullif(count(*) FILTER (WHERE event_time >= as_of - INTERVAL 6 HOUR), 0) AS temp_6h,
  CAST(sum(vibration_mm_s) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR) AS DOUBLE) / nullif(count(*) FILTER (WHERE event_time >= as_of - INTERVAL 1 HOUR), 0) AS vib_1h,
  CAST(sum(vibration_mm_s) FILTER (WHERE event_time >= as_of - INTERVAL 6 HOUR) AS DOUBLE) / nullif(count(*) FILTER (WHERE event_time >= as_of - INTERVAL 6 HOUR), 0) AS vib_6h
  FROM readings, newest GROUP BY ALL),
raised_day AS (SELECT machine_id, count(*) AS n FROM failure_alerts, newest WHERE event_time >= as_of - INTERVAL 24 HOUR GROUP BY ALL)
SELECT m.machine_id, temp_1h, temp_6h, round(temp_1h - temp_6h, 2) AS temp_drift, vib_1h, vib_6h, round(vib_1h - vib_6h, 2) AS vib_drift,
  coalesce(n, 0) AS alerts_last_24h, CASE WHEN coalesce(n, 0) >= 3 OR temp_1h - temp_6h > 5 OR vib_1h - vib_6h > 2 THEN 'HIGH_RISK'
  WHEN coalesce(n, 0) >= 1 OR temp_1h - temp_6h > 2 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS maintenance_risk
FROM mean m LEFT JOIN raised_day a ON a.machine_id = m.machine_id""")
def predictive(x: Context):
    return kpis.predictive_maintenance(x.facts.readings, x.facts.failure_alerts, x.facts.newest_reading, x.facts.machine_ids)


OEE_VIEW_SQL = """SELECT machine_id, production_date, planned_minutes, round(run / 60, 2) AS run_minutes,
  round((run / 60) / nullif(CAST(planned_minutes AS DOUBLE), 0) * 100, 2) AS availability_pct, round(ideal / nullif(run, 0) * 100, 2) AS performance_pct,
  round(good / nullif(units, 0) * 100, 2) AS quality_pct,
  round((run / 60) / nullif(CAST(planned_minutes AS DOUBLE), 0) * (ideal / nullif(run, 0)) * (good / nullif(units, 0)) * 100, 2) AS oee_pct
FROM (SELECT k.machine_id, CAST(k.window_start AS DATE) AS production_date, p.planned_minutes, CAST(sum(running_seconds) AS DOUBLE) AS run,
  CAST(sum(units_produced) AS DOUBLE) AS units, CAST(sum(good_units) AS DOUBLE) AS good,
  CAST(m.ideal_cycle_time_sec AS DOUBLE) * CAST(sum(units_produced) AS DOUBLE) AS ideal
FROM minutes k JOIN master m ON m.machine_id = k.machine_id
LEFT JOIN planned p ON p.machine_id = k.machine_id AND p.production_date = CAST(k.window_start AS DATE)
GROUP BY k.machine_id, CAST(k.window_start AS DATE), p.planned_minutes, m.ideal_cycle_time_sec)"""


def oee_view(x):
    return kpis.oee(x.facts.minute_kpis, x.facts.master, x.facts.planned_time)


query("kpi8", OEE_VIEW_SQL)(oee_view)

# ---- measures of the hourly fact, by machine ------------------------------------
_MEMBER = "(SELECT machine_id, CAST(ideal_cycle_time_sec AS DOUBLE) AS mean_ideal, CAST(rated_power_kw AS DOUBLE) AS rated FROM dim_machine) d"
_BY_MACHINE = f"FROM ({parts('machine_id')}) c"
_JOINED = _BY_MACHINE + f" JOIN {_MEMBER} ON d.machine_id = c.machine_id"
_STOPPED = f"FROM ({parts('machine_id')}) c FULL JOIN ({stop_parts('machine_id', '(SELECT s.*, d.machine_id AS mid FROM stops s JOIN dim_machine d ON d.machine_key = s.machine_key)').replace('machine_id,', 'mid AS machine_id,', 1).replace('GROUP BY machine_id', 'GROUP BY mid')}) s ON s.machine_id = c.machine_id"
_ALERTED = f"FROM ({parts('machine_id')}) c FULL JOIN ({alert_parts('machine_id', '(SELECT s.*, d.machine_id AS mid FROM alerts s JOIN dim_machine d ON d.machine_key = s.machine_key)').replace('machine_id,', 'mid AS machine_id,', 1).replace('GROUP BY machine_id', 'GROUP BY mid')}) a ON a.machine_id = c.machine_id"
_D = lambda c: f"CAST({c} AS DOUBLE)"
MTBF = "(CAST(c_run AS DOUBLE) / 60) / nullif(CAST(c_stops AS DOUBLE), 0) / 60"
MTTR = "c_stop_min / nullif(CAST(c_stops AS DOUBLE), 0) / 60"

# id → (measures, SQL expressions, source)
BY_MACHINE: dict[str, tuple[dict[str, str], str]] = {
    "m1": ({"total_readings": "c_readings"}, _BY_MACHINE),
    "m2_m4": ({"total_units": "c_units", "total_good_units": "c_good", "total_scrap_units": "c_scrap"}, _BY_MACHINE),
    "m5_m8": ({"total_runtime_min": "CAST(c_run AS DOUBLE) / 60", "total_idle_min": "CAST(c_idle AS DOUBLE) / 60",
               "total_downtime_min": "CAST(c_down AS DOUBLE) / 60", "total_planned_min": "c_planned"}, _BY_MACHINE),
    "m9": ({"avg_temperature_c": "c_temp / c_n"}, _BY_MACHINE),
    "m10": ({"max_temperature_c": "c_max"}, _BY_MACHINE),
    "m11": ({"avg_vibration_mm_s": "c_vib"}, _BY_MACHINE),
    "m12": ({"availability": A, "availability_all_stops":
             "(CAST(c_run AS DOUBLE) / 60) / nullif(c_planned - CAST(c_down AS DOUBLE) / 60, 0)"}, _BY_MACHINE),
    "m13": ({"performance": P}, _BY_MACHINE),
    "m14": ({"quality": Q}, _BY_MACHINE),
    "m15": ({"oee": OEE}, _BY_MACHINE),
    "m16_m17": ({"oee_target": "CAST(0.85 AS DOUBLE)", "oee_vs_target": f"{OEE} - CAST(0.85 AS DOUBLE)"}, _BY_MACHINE),
    "m18": ({"oee_gap_units": "CAST(c_run AS DOUBLE) / nullif(mean_ideal, 0) - CAST(c_units AS DOUBLE)"}, _JOINED),
    "m19_m21": ({"availability_loss_min": "c_planned - CAST(c_pstop AS DOUBLE) / 60 - CAST(c_run AS DOUBLE) / 60",
                 "performance_loss_min": f"CAST(c_run AS DOUBLE) / 60 * (1 - {P})",
                 "quality_loss_min": "CAST(c_scrap AS DOUBLE) * mean_ideal / 60"}, _JOINED),
    "m22_m24": ({"scrap_rate": "CAST(c_scrap AS DOUBLE) / nullif(CAST(c_units AS DOUBLE), 0)", "first_pass_yield": Q,
                 "defects_per_million": "CAST(c_scrap AS DOUBLE) / nullif(CAST(c_units AS DOUBLE), 0) * 1000000"}, _BY_MACHINE),
    "m25": ({"downtime_events": "coalesce(c_stops, 0)"}, _STOPPED),
    "m26_m27": ({"mtbf_hours": MTBF, "mttr_hours": MTTR}, _STOPPED),
    "m28": ({"technical_availability": f"({MTBF}) / nullif(({MTBF}) + ({MTTR}), 0)"}, _STOPPED),
    "m29": ({"open_downtime_events": "coalesce(c_open, 0)"}, _STOPPED),
    "m30": ({"unplanned_downtime_min": "c_unplanned"}, _STOPPED),
    "m31_m33": ({"total_alerts": "c_alerts", "active_alerts": "c_active", "critical_alerts": "c_crit"}, _ALERTED),
    "m35": ({"mtta_min": "c_ack / nullif(CAST(c_acked AS DOUBLE), 0)"}, _ALERTED),
    "m36": ({"sla_compliance": "CAST(c_in_sla AS DOUBLE) / nullif(CAST(c_acknowledged AS DOUBLE), 0)"}, _ALERTED),
    "m37": ({"alerts_per_1k_units": "CAST(c_alerts AS DOUBLE) / nullif(CAST(c_units AS DOUBLE), 0) * 1000"}, _ALERTED),
    "m38_m39": ({"total_energy_kwh": "c_kws / 3600", "energy_per_unit_kwh": "c_kws / 3600 / nullif(CAST(c_units AS DOUBLE), 0)"}, _BY_MACHINE),
    "m40": ({"energy_cost": "c_kws / 3600 * CAST(0.14 AS DOUBLE)"}, _BY_MACHINE),
    "m41": ({"energy_intensity_vs_rated": "(c_kws / 3600 * 60) / nullif(CAST(c_run AS DOUBLE) / 60, 0) / nullif(rated, 0)"}, _JOINED),
    "m50": ({"oee_status_colour": f"CASE WHEN {OEE} >= CAST(0.85 AS DOUBLE) THEN '#2E7D32' WHEN {OEE} >= CAST(0.65 AS DOUBLE) THEN '#F9A825' ELSE '#C62828' END"}, _BY_MACHINE),
    "m53": ({"last_refresh": "c_end"}, _BY_MACHINE),
}


def _register() -> None:
    for name, (exprs, source) in BY_MACHINE.items():
        who = "coalesce(c.machine_id, s.machine_id)" if source is _STOPPED else (
            "coalesce(c.machine_id, a.machine_id)" if source is _ALERTED else "c.machine_id")
        body = f"SELECT {who} AS machine_id, " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + f" {source}"
        names = tuple(exprs)
        query(name, body)(lambda x, names=names: measures(x.facts, names, ("machine_id",)))


_register()


@query("m34", """SELECT count(*) AS alerts_last_24h FROM alerts WHERE raised_at >= (SELECT max(raised_at) FROM alerts) - INTERVAL 1 DAY""")
def alerts_day(x: Context):
    return alerts_last_day(x.facts.alerts)


@query("m49", f"""SELECT full_date, {OEE} AS oee FROM ({parts('full_date')}) WHERE full_date <= DATE '2024-01-20'""")
def visual(x: Context):
    return reports.oee_trend(x.facts, F.lit("2024-01-20").cast("timestamp")).select("full_date", "oee")


@query("m52", f"SELECT production_line, c_machines AS selected_machines FROM ({parts('production_line')})")
def selected(x: Context):
    return measures(x.facts, ("selected_machines",), ("production_line",))


# ---- time intelligence over years of order lines ---------------------------------
def line_days(x: Context):
    return window_components(tables.line_output(x.table("lineitem")), ["full_date"])


_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_TO = {p: f"OVER (PARTITION BY date_trunc('{n}', full_date) ORDER BY full_date {_RUN})"
       for p, n in (("mtd", "month"), ("qtd", "quarter"), ("ytd", "year"))}


def _period(name: str, ident: str) -> None:
    @query(ident, f"SELECT full_date, {line_oee(_TO[name])} AS oee FROM line_days")
    def to_date(x: Context):
        return timeintel.period_to_date(line_days(x), "full_date", name).select("full_date", oee().alias("oee"))


_period("mtd", "m42")
_period("qtd", "m43")

_MONTHS = """(SELECT CAST(date_trunc('month', full_date) AS DATE) AS month_start, CAST(sum(u) AS BIGINT) AS u, CAST(sum(g) AS BIGINT) AS g, CAST(sum(r) AS BIGINT) AS r,
  CAST(sum(s) AS BIGINT) AS s, CAST(sum(p) AS BIGINT) AS p, CAST(sum(i) AS BIGINT) AS i FROM line_days GROUP BY ALL)"""
_MONTH_OEE = f"(SELECT month_start, {line_oee()} AS oee FROM {_MONTHS})"


@query("m44_m45", f"""SELECT a.month_start, a.oee, b.oee AS oee_pm, (a.oee - b.oee) / nullif(b.oee, 0) AS oee_mom
FROM {_MONTH_OEE} a LEFT JOIN {_MONTH_OEE} b ON b.month_start = a.month_start - INTERVAL 1 MONTH""")
def month_over_month(x: Context):
    return reports.monthly_oee(line_days(x), "full_date")


_DAY_OEE = f"(SELECT full_date, {line_oee()} AS oee FROM line_days)"


@query("m46", f"""SELECT a.full_date, a.oee, b.oee AS oee_py FROM {_DAY_OEE} a LEFT JOIN {_DAY_OEE} b ON b.full_date = CAST(a.full_date - INTERVAL 12 MONTH AS DATE)""")
def prior_year(x: Context):
    days = line_days(x).select("full_date", oee().alias("oee"))
    return timeintel.shifted(days, "full_date", "oee", 12, "oee_py")


@query("m47_m48", f"""SELECT full_date, {line_oee("OVER (ORDER BY full_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)")} AS oee_7d,
  {line_oee("OVER (ORDER BY full_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)")} AS oee_30d FROM line_days""")
def rolling(x: Context):
    days = line_days(x)
    week = timeintel.rolling(days, "full_date", 7).select("full_date", oee().alias("oee_7d"))
    month = timeintel.rolling(days, "full_date", 30).select("full_date", oee().alias("oee_30d"))
    return week.join(month, "full_date")


@query("m51", f"""SELECT month_start, CASE WHEN d > 0.02 THEN '▲ +' || format('{{:.1f}}', abs(d) * 100) || '%' WHEN d < -0.02 THEN '▼ -' || format('{{:.1f}}', abs(d) * 100) || '%' ELSE 'Flat' END AS trend
FROM (SELECT a.month_start, a.oee - b.oee AS d FROM {_MONTH_OEE} a LEFT JOIN {_MONTH_OEE} b ON b.month_start = a.month_start - INTERVAL 1 MONTH)""")
def trend_marks(x: Context):
    months = reports.monthly_oee(line_days(x), "full_date")
    return months.select("month_start", trend(F.col("oee") - F.col("oee_pm")).alias("trend"))


@query("wn9", """SELECT full_date, machine_key, CAST(sum(u) OVER (PARTITION BY machine_key ORDER BY full_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS units_7d
FROM (SELECT machine_key, full_date, sum(units) AS u FROM line_output GROUP BY ALL)""")
def rolling_units(x: Context):
    days = window_components(tables.line_output(x.table("lineitem")), ["machine_key", "full_date"])
    return timeintel.rolling(days, "full_date", 7, ["machine_key"], ["c_units"]).select(
        "full_date", "machine_key", F.col("c_units").alias("units_7d"))


@query("wn10", f"""SELECT full_date, CAST(sum(u) {_TO['mtd']} AS BIGINT) AS mtd, CAST(sum(u) {_TO['qtd']} AS BIGINT) AS qtd, CAST(sum(u) {_TO['ytd']} AS BIGINT) AS ytd FROM line_days""")
def to_date_units(x: Context):
    return timeintel.time_calculations(line_days(x), "full_date", F.col("c_units")).select("full_date", "mtd", "qtd", "ytd")


@query("wn11", f"""SELECT a.month_start, a.u AS units, b.u AS units_pm FROM {_MONTHS} a LEFT JOIN {_MONTHS} b ON b.month_start = a.month_start - INTERVAL 1 MONTH""")
def prior_month(x: Context):
    months = timeintel.monthly(line_days(x), "full_date").select("month_start", F.col("c_units").alias("units"))
    return timeintel.previous_month(months, "units", "units_pm")


@query("wn12", """SELECT a.full_date, a.u AS units, b.u AS units_py, (a.u - b.u) / nullif(CAST(b.u AS DOUBLE), 0) AS yoy
FROM line_days a LEFT JOIN line_days b ON b.full_date = CAST(a.full_date - INTERVAL 12 MONTH AS DATE)""")
def year_over_year(x: Context):
    days = line_days(x).select("full_date", F.col("c_units").alias("units"))
    out = timeintel.shifted(days, "full_date", "units", 12, "units_py")
    return out.withColumn("yoy", timeintel.growth(F.col("units").cast("double"), F.col("units_py").cast("double")))


@query("wn13", f"""SELECT full_date, cur.oee AS current, mtd.oee AS mtd, qtd.oee AS qtd, ytd.oee AS ytd, py.oee AS py, (cur.oee - py.oee) / nullif(py.oee, 0) AS yoy
FROM (SELECT full_date, {line_oee()} AS oee FROM line_all_days) cur
JOIN (SELECT full_date, {line_oee(_TO['mtd'])} AS oee FROM line_all_days) mtd USING (full_date)
JOIN (SELECT full_date, {line_oee(_TO['qtd'])} AS oee FROM line_all_days) qtd USING (full_date)
JOIN (SELECT full_date, {line_oee(_TO['ytd'])} AS oee FROM line_all_days) ytd USING (full_date)
LEFT JOIN (SELECT CAST(full_date AS DATE) AS d, {line_oee()} AS oee FROM line_all_days) py ON py.d = CAST(full_date - INTERVAL 12 MONTH AS DATE)""")
def calculation_group(x: Context):
    axis = timeintel.daily_axis(line_days(x), "full_date", WINDOW_PARTS)
    return timeintel.time_calculations(axis, "full_date", oee())


# ---- first-generation measures ---------------------------------------------------
@query("m54_m58", f"""SELECT count(*) FILTER (WHERE status = 'RUNNING') AS running, count(*) FILTER (WHERE status = 'IDLE') AS idle, count(*) FILTER (WHERE status = 'DOWN') AS down,
  count(*) FILTER (WHERE status = 'FAULT') AS fault, CAST(count(*) FILTER (WHERE connectivity = 'ONLINE') AS DOUBLE) / count(*) AS online FROM ({LIVE_SQL})""")
def legacy_status(x: Context):
    is_ = lambda s: F.count_if(F.col("status") == s)
    return live(x).agg(is_("RUNNING").alias("running"), is_("IDLE").alias("idle"), is_("DOWN").alias("down"),
                       is_("FAULT").alias("fault"),
                       F.try_divide(F.count_if(F.col("connectivity") == "ONLINE"), F.count("*")).alias("online"))


@query("m59_m61", f"""SELECT {mean('avg_temp_last_1h')} AS avg_1h, {mean('avg_temp_last_24h')} AS avg_24h, max(max_temp_last_24h) AS max_24h FROM ({TEMP_SQL})""")
def legacy_temperature(x: Context):
    return temperature(x).agg(steady_mean("avg_temp_last_1h").alias("avg_1h"),
                              steady_mean("avg_temp_last_24h").alias("avg_24h"), F.max("max_temp_last_24h").alias("max_24h"))


@query("m62_m63", f"""SELECT count(*) FILTER (WHERE NOT acknowledged) AS active, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical FROM ({ALERT_SQL})""")
def legacy_alerts(x: Context):
    return alert_view(x).agg(F.count_if(~F.col("acknowledged")).alias("active"),
                             F.count_if(F.col("severity") == "CRITICAL").alias("critical"))


@query("m64_m67", f"""SELECT (SELECT {mean('utilization_pct', 2)} FROM ({UTIL_SQL})) AS utilization_pct, (SELECT {total('total_kwh')} FROM ({POWER_SQL})) AS total_kwh,
  (SELECT {total('total_downtime_minutes', 2)} FROM ({DOWN_SQL})) AS downtime_min, (SELECT CAST(sum(downtime_events) AS BIGINT) FROM ({DOWN_SQL})) AS downtime_events""")
def legacy_totals(x: Context):
    return (utilization(x).agg(steady_mean("utilization_pct", 2).alias("utilization_pct"))
            .crossJoin(power(x).agg(steady_sum("total_kwh").alias("total_kwh")))
            .crossJoin(downtime(x).agg(steady_sum("total_downtime_minutes", 2).alias("downtime_min"),
                                       F.sum("downtime_events").alias("downtime_events"))))


@query("m68_m71", "SELECT " + ", ".join(f"{mean(c + '_pct', 2)} / 100 AS {c}" for c in ("availability", "performance", "quality", "oee")) + f" FROM ({OEE_VIEW_SQL})")
def legacy_oee(x: Context):
    return oee_view(x).agg(*[(steady_mean(f"{c}_pct", 2) / 100).alias(c)
                             for c in ("availability", "performance", "quality", "oee")])
