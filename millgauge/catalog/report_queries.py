"""Report datasets."""

from __future__ import annotations

from ..plans import reports
from ..sources import seeds
from .indicators import DOWN_SQL, MTBF, MTTR, OEE_VIEW_SQL, POWER_SQL, UTIL_SQL
from .registry import Context, query
from .sql import A, OEE, P, Q, alert_parts, mean, parts, stop_parts, total

_ALERTS_BY_KEY = "(SELECT x.*, d.machine_id AS mid FROM alerts x JOIN dim_machine d ON d.machine_key = x.machine_key)"
_BY_MID = alert_parts("mid", _ALERTS_BY_KEY)
_STOPS_BY_KEY = "(SELECT x.*, d.machine_id AS mid, CAST(date_trunc('month', started_at) AS DATE) AS month_start FROM stops x JOIN dim_machine d ON d.machine_key = x.machine_key)"


@query("rpt1", f"""SELECT {OEE} AS oee, {A} AS availability, {P} AS performance, {Q} AS quality, c_active AS active_alerts, c_temp / c_n AS avg_temperature_c,
  CAST(c_down AS DOUBLE) / 60 AS total_downtime_min, c_kws / 3600 / nullif(CAST(c_units AS DOUBLE), 0) AS energy_per_unit_kwh
FROM ({parts('')}), ({alert_parts('')})""")
def overview(x: Context):
    return reports.overview(x.facts)


@query("rpt2", f"SELECT full_date, {OEE} AS oee, CAST(0.85 AS DOUBLE) AS oee_target FROM ({parts('full_date')})")
def oee_trend(x: Context):
    return reports.oee_trend(x.facts)


@query("rpt3", f"""SELECT coalesce(c.machine_id, a.mid) AS machine_id, c_temp / c_n AS avg_temperature_c, {OEE} AS oee, c_active AS active_alerts, s.status_name, s.display_colour_hex
FROM ({parts('machine_id')}) c FULL JOIN ({_BY_MID}) a ON a.mid = c.machine_id
LEFT JOIN (SELECT machine_id, max_by(status, (event_time, reading_id)) AS status FROM readings GROUP BY ALL) l ON l.machine_id = c.machine_id
LEFT JOIN dim_status s ON s.status_code = upper(l.status)""")
def machine_table(x: Context):
    return reports.machine_table(x.facts)


@query("rpt4", f"SELECT machine_name, {OEE} AS oee, {A} AS availability, {P} AS performance, {Q} AS quality FROM ({parts('machine_name')}) ORDER BY oee DESC")
def oee_by_machine(x: Context):
    return reports.oee_by_machine(x.facts)


@query("rpt5", f"SELECT full_date, c_units AS total_units, {OEE} AS oee FROM ({parts('full_date')})")
def units_by_date(x: Context):
    return reports.units_by_date(x.facts)


_IDS = [m[0] for m in seeds.MACHINES]
_CELL = f"SELECT s.shift_name, machine_id, {OEE} AS oee FROM ({parts('shift_key, machine_id')}) c JOIN dim_shift s ON s.shift_key = c.shift_key"


@query("rpt6", "SELECT shift_name, " + ", ".join(f"max(oee) FILTER (WHERE machine_id = '{m}') AS \"{m}\"" for m in _IDS) + f" FROM ({_CELL}) GROUP BY ALL")
def shift_matrix(x: Context):
    return reports.shift_matrix(x.facts, _IDS)


@query("ag21", "SELECT shift_name, " + ", ".join(f"max(oee) FILTER (WHERE machine_id = '{m}') AS \"{m}\"" for m in (*_IDS, "UNKNOWN")) + f" FROM ({_CELL}) GROUP BY ALL")
def cross_tab(x: Context):
    return reports.shift_matrix(x.facts, [*_IDS, "UNKNOWN"])


@query("rpt6_shift", f"SELECT c.shift_key, s.shift_name, {OEE} AS oee, c_units AS total_units FROM ({parts('shift_key')}) c JOIN dim_shift s ON s.shift_key = c.shift_key")
def by_shift(x: Context):
    return reports.oee_by_shift(x.facts)


@query("rpt7", f"SELECT full_date, machine_id, c_kws / 3600 AS total_energy_kwh FROM ({parts('full_date, machine_id')})")
def energy_by_date(x: Context):
    return reports.energy_by_date(x.facts)


@query("rpt7_unit", f"SELECT machine_id, c_kws / 3600 AS total_energy_kwh, c_kws / 3600 / nullif(CAST(c_units AS DOUBLE), 0) AS energy_per_unit_kwh FROM ({parts('machine_id')})")
def energy_per_unit(x: Context):
    return reports.energy_per_unit(x.facts)


@query("rpt8", f"""SELECT machine_id, measure, value FROM (SELECT c.machine_id, c_planned - CAST(c_pstop AS DOUBLE) / 60 - CAST(c_run AS DOUBLE) / 60 AS availability_loss_min,
  CAST(c_run AS DOUBLE) / 60 * (1 - {P}) AS performance_loss_min, CAST(c_scrap AS DOUBLE) * CAST(d.ideal_cycle_time_sec AS DOUBLE) / 60 AS quality_loss_min
  FROM ({parts('machine_id')}) c JOIN dim_machine d ON d.machine_id = c.machine_id)
UNPIVOT INCLUDE NULLS (value FOR measure IN (availability_loss_min, performance_loss_min, quality_loss_min))""")
def waterfall(x: Context):
    return reports.loss_waterfall(x.facts)


@query("ag22", f"""SELECT machine_id, measure, value FROM (SELECT machine_id, {OEE} AS oee, {A} AS availability, {P} AS performance, {Q} AS quality,
  CAST(c_scrap AS DOUBLE) / nullif(CAST(c_units AS DOUBLE), 0) AS scrap_rate FROM ({parts('machine_id')}))
UNPIVOT INCLUDE NULLS (value FOR measure IN (oee, availability, performance, quality, scrap_rate))""")
def picker(x: Context):
    return reports.measure_picker(x.facts)


@query("rpt9", f"""SELECT {MTBF} AS mtbf_hours, {MTTR} AS mttr_hours, CAST(c_in_sla AS DOUBLE) / nullif(CAST(c_acknowledged AS DOUBLE), 0) AS sla_compliance,
  c_open AS open_downtime_events FROM ({parts('')}), ({stop_parts('')}), ({alert_parts('')})""")
def reliability(x: Context):
    return reports.reliability(x.facts)


@query("rpt10", """SELECT reading_id, raised_at, machine_name, alert_name, severity, time_to_acknowledge_min AS mtta_min, breached_sla
FROM alerts a LEFT JOIN dim_machine d ON d.machine_key = a.machine_key""")
def alert_log(x: Context):
    return reports.alert_log(x.facts)


@query("rpt11", "SELECT CAST(raised_at AS DATE) AS full_date, severity, count(*) AS total_alerts FROM alerts GROUP BY ALL")
def alerts_by_date(x: Context):
    return reports.alerts_by_date(x.facts)


@query("rpt12", """SELECT machine_id, is_planned, count(*) AS stops, CAST(sum(CAST(duration_minutes AS DECIMAL(18,2))) AS DOUBLE) AS downtime_min FROM stops GROUP BY ALL""")
def by_plan(x: Context):
    return reports.downtime_by_plan(x.facts)


@query("rpt13", f"""SELECT coalesce(c.machine_id, s.mid) AS machine_id, coalesce(c.month_start, s.month_start) AS month_start, {MTBF} AS mtbf_hours, {MTTR} AS mttr_hours, CAST(c_down AS DOUBLE) / 60 AS total_downtime_min
FROM ({parts('machine_id, month_start', "(SELECT *, CAST(date_trunc('month', window_start) AS DATE) AS month_start FROM cells)")}) c
FULL JOIN ({stop_parts('mid, month_start', _STOPS_BY_KEY)}) s ON s.mid = c.machine_id AND s.month_start = c.month_start""")
def quadrant(x: Context):
    return reports.reliability_quadrant(x.facts)


@query("rpt14", """SELECT machine_id, shift_key, reason_code, CAST(grouping_id(machine_id, shift_key, reason_code) AS INTEGER) AS level,
  count(*) AS stops, CAST(sum(CAST(duration_minutes AS DECIMAL(18,2))) AS DOUBLE) AS downtime_min FROM stops GROUP BY ROLLUP (machine_id, shift_key, reason_code)""")
def drill(x: Context):
    return reports.downtime_drill(x.facts)


@query("rpt15", """SELECT 'reading' AS kind, event_time AS at, upper(status) AS label, CAST(temperature_c AS DOUBLE) AS value FROM readings WHERE machine_id = 'M-104'
UNION ALL SELECT 'alert', raised_at, a.alert_code, trigger_value FROM alerts r JOIN dim_alert_type a ON a.alert_type_key = r.alert_type_key WHERE machine_id = 'M-104'
UNION ALL SELECT 'stop', started_at, reason_code, duration_minutes FROM stops WHERE machine_id = 'M-104'""")
def detail(x: Context):
    return reports.machine_detail(x.facts, "M-104")


@query("rpt16", f"""SELECT coalesce(c.machine_id, '') AS machine_id, window_start, {OEE} AS oee, c_active AS active_alerts
FROM ({parts('machine_id, window_start', 'cells, newest', 'WHERE window_end > as_of - INTERVAL 24 HOUR')}) c LEFT JOIN ({_BY_MID}) a ON a.mid = c.machine_id""")
def tooltip(x: Context):
    return reports.machine_tooltip(x.facts)


@query("rpt17", f"""SELECT o.*, utilization_pct, total_kwh, total_downtime_minutes FROM
(SELECT machine_id, {mean('availability_pct', 2)} AS availability_pct, {mean('performance_pct', 2)} AS performance_pct, {mean('quality_pct', 2)} AS quality_pct,
  {mean('oee_pct', 2)} AS oee_pct FROM ({OEE_VIEW_SQL}) GROUP BY ALL) o
JOIN (SELECT machine_id, {mean('utilization_pct', 2)} AS utilization_pct FROM ({UTIL_SQL}) GROUP BY ALL) u USING (machine_id)
JOIN (SELECT machine_id, {total('total_kwh')} AS total_kwh FROM ({POWER_SQL}) GROUP BY ALL) p USING (machine_id)
LEFT JOIN (SELECT machine_id, {total('total_downtime_minutes', 2)} AS total_downtime_minutes FROM ({DOWN_SQL}) GROUP BY ALL) d USING (machine_id)""")
def first_pages(x: Context):
    return reports.first_generation_page(x.facts)
