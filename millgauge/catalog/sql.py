"""Shared relations of the comparison SQL, written for DuckDB.

``complete`` puts the relations that a query mentions in front of it. They state
the same rules as the Spark side, independently and without its operators.
"""

from __future__ import annotations

import re

from ..operators.dimensions import LINES
from ..sources import seeds


def _seed(columns: str, rows: list[tuple]) -> str:
    fields = [c.strip().split(" ", 1) for c in columns.split(";")]
    kinds = {"string": "VARCHAR"}
    body = ", ".join("(" + ", ".join(_text(v) for v in r) + ")" for r in rows)
    cast = ", ".join(f"CAST({n} AS {kinds.get(k, k)}) AS {n}" for n, k in fields)
    return f"SELECT {cast} FROM (VALUES {body}) t({', '.join(n for n, _ in fields)})"


def _text(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (bool, int, float)):
        return str(v).upper()
    return "'" + v.replace("'", "''") + "'"


def key(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def keys_of(ts: str) -> str:
    """Date, time and shift keys of a timestamp expression."""
    minute = f"(hour({ts}) * 60 + minute({ts}))"
    return (
        f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER) AS date_key, CAST({minute} AS SMALLINT) AS time_key, "
        f"CAST(CASE WHEN {minute} < 360 OR {minute} >= 1320 THEN 3 WHEN {minute} < 840 THEN 1 ELSE 2 END AS SMALLINT) AS shift_key"
    )


REARM = "INTERVAL 60 MINUTE"

RELATIONS: dict[str, str] = {
    "readings": """
SELECT event_id AS reading_id,
  concat('M-', CAST(101 + user_id % 6 AS STRING)) AS machine_id,
  CAST(ts AS TIMESTAMP) AS event_time,
  CAST(30 + CAST(value AS DECIMAL(10,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(10,3)) AS temperature_c,
  CAST(CAST(value AS DECIMAL(10,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(10,3)) AS power_kw,
  CAST(CAST(event_id % 80 AS DECIMAL(10,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(10,3)) AS vibration_mm_s,
  CASE event_type
    WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'FAULT' ELSE 'DOWN' END
    WHEN 'signup' THEN 'IDLE' WHEN 'view' THEN 'running' WHEN 'click' THEN 'RUNNING'
    ELSE CASE WHEN event_id % 50 = 0 THEN 'TELEPORTING' ELSE 'RUNNING' END END AS status,
  CASE WHEN event_type IN ('click','view','purchase') THEN CAST(1 + user_id % 3 AS INT) ELSE 0 END AS units_produced,
  CASE WHEN event_type IN ('click','view','purchase')
       THEN CAST(1 + user_id % 3 AS INT) - CASE WHEN event_id % 33 = 0 THEN 1 ELSE 0 END
       ELSE 0 END AS good_units
FROM events""",
    "newest": "SELECT max(event_time) AS as_of FROM readings",
    "master": _seed(seeds.MASTER_COLUMNS, seeds.MACHINES),
    "dim_status": _seed(seeds.STATUS_COLUMNS, seeds.STATUSES),
    "dim_shift": _seed(seeds.SHIFT_COLUMNS, seeds.SHIFTS),
    "dim_alert_type": _seed(seeds.ALERT_TYPE_COLUMNS, [seeds.UNKNOWN_ALERT_TYPE, *seeds.ALERT_TYPES]),
    "user_scope": _seed(seeds.SCOPE_COLUMNS, seeds.SCOPES),
    "dim_machine": f"""
SELECT {key("machine_id || '|1970-01-01 00:00:00'")} AS machine_key, machine_id, machine_name, machine_type, location,
  coalesce((SELECT 'LINE-' || min(line) FROM (VALUES {", ".join(f"('{x}')" for x in LINES)}) l(line)
      WHERE regexp_matches(location, 'line[ -]' || line, 'i')),
    if(TRY_CAST(right(machine_id, 1) AS INTEGER) <= 3, 'LINE-A', 'LINE-B')) AS production_line,
  'PLANT-01' AS plant_code, installed_date, ideal_cycle_time_sec, manufacturer, rated_power_kw,
  CASE WHEN upper(machine_type) IN ('CNC', 'PRESS') THEN 'HIGH' ELSE 'MEDIUM' END AS criticality,
  coalesce(is_active, TRUE) AS is_active, FALSE AS is_inferred,
  TIMESTAMP '1970-01-01 00:00:00' AS valid_from, TIMESTAMP '9999-12-31 23:59:59' AS valid_to, TRUE AS is_current
FROM master
UNION ALL
SELECT -1, 'UNKNOWN', 'Unknown Machine', 'UNKNOWN', NULL, 'UNKNOWN', 'UNKNOWN', NULL, 1.0, NULL, NULL, 'LOW', TRUE, TRUE,
  TIMESTAMP '1970-01-01 00:00:00', TIMESTAMP '9999-12-31 23:59:59', TRUE""",
    "conformed": f"""
SELECT r.*, CAST(r.event_time AS DATE) AS event_date, {keys_of('r.event_time')},
  CAST(CASE WHEN r.temperature_c > 150 OR r.temperature_c < -20 THEN 2 ELSE 1 END AS SMALLINT) AS flags_key,
  coalesce(m.machine_key, -1) AS machine_key, coalesce(s.status_key, -1) AS status_key,
  m.ideal_cycle_time_sec, s.is_productive, s.is_downtime, s.is_planned_downtime
FROM readings r
LEFT JOIN dim_machine m ON m.machine_id = r.machine_id
LEFT JOIN dim_status s ON s.status_code = upper(r.status) AND s.status_key > 0""",
    "sensor": """
SELECT reading_id, date_key, time_key, machine_key, status_key, shift_key, flags_key, event_time AS event_ts, event_date,
  temperature_c, power_kw, vibration_mm_s, coalesce(units_produced, 0) AS units_produced,
  coalesce(good_units, 0) AS good_units, CAST(5.0 AS DOUBLE) AS runtime_seconds
FROM conformed""",
    "hourly_parts": """
SELECT machine_key, date_trunc('hour', event_time) AS window_start, count(*) AS reading_count,
  CAST(sum(units_produced) AS BIGINT) AS units_produced, CAST(sum(good_units) AS BIGINT) AS good_units,
  5 * count(*) FILTER (WHERE is_productive) AS runtime_seconds,
  5 * count(*) FILTER (WHERE upper(status) = 'IDLE') AS idle_seconds,
  5 * count(*) FILTER (WHERE is_downtime) AS downtime_seconds,
  5 * count(*) FILTER (WHERE is_planned_downtime) AS planned_stop_seconds,
  5 * sum(power_kw) AS kw_seconds, sum(temperature_c) AS temp_sum, max(temperature_c) AS max_temperature_c,
  sum(vibration_mm_s) AS vibration_sum, count(vibration_mm_s) AS vibration_count, max(vibration_mm_s) AS max_vibration_mm_s
FROM conformed GROUP BY ALL""",
    "hourly": f"""
SELECT p.*, window_start + INTERVAL 1 HOUR AS window_end, {keys_of('window_start')},
  units_produced - good_units AS scrap_units,
  CAST(runtime_seconds AS DOUBLE) / 60 AS runtime_minutes, CAST(idle_seconds AS DOUBLE) / 60 AS idle_minutes,
  CAST(downtime_seconds AS DOUBLE) / 60 AS downtime_minutes, CAST(60 AS DOUBLE) AS planned_minutes,
  CAST(kw_seconds AS DOUBLE) / 3600 AS energy_kwh,
  CAST(temp_sum AS DOUBLE) / reading_count AS avg_temperature_c,
  CAST(vibration_sum AS DOUBLE) / vibration_count AS avg_vibration_mm_s
FROM hourly_parts p""",
    "minutes": """
SELECT machine_id, date_trunc('minute', event_time) AS window_start,
  date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, count(*) AS reading_count,
  sum(temperature_c) AS temp_sum, CAST(sum(temperature_c) AS DOUBLE) / count(temperature_c) AS avg_temperature_c,
  max(temperature_c) AS max_temperature_c, CAST(sum(power_kw) AS DOUBLE) / count(power_kw) AS avg_power_kw,
  CAST(sum(power_kw) AS DOUBLE) / 60 AS total_power_kwh,
  count(*) FILTER (WHERE status = 'RUNNING') AS running_seconds, count(*) FILTER (WHERE status = 'IDLE') AS idle_seconds,
  count(*) FILTER (WHERE status IN ('DOWN', 'FAULT')) AS down_seconds,
  CAST(sum(units_produced) AS BIGINT) AS units_produced, CAST(sum(good_units) AS BIGINT) AS good_units, sum(power_kw) AS power_sum
FROM readings GROUP BY ALL""",
    "candidates": """
SELECT c.*, 'FAULT_STATUS' AS alert_code, CAST(temperature_c AS DOUBLE) AS trigger_value, CAST(NULL AS DOUBLE) AS threshold_value
FROM conformed c WHERE upper(status) IN ('FAULT', 'DOWN')
UNION ALL SELECT c.*, 'HIGH_TEMP', CAST(temperature_c AS DOUBLE), 85.0 FROM conformed c WHERE temperature_c > 85
UNION ALL SELECT c.*, 'HIGH_VIBRATION', CAST(vibration_mm_s AS DOUBLE), 4.5 FROM conformed c WHERE vibration_mm_s > 4.5""",
    "raised": f"""
SELECT c.*, a.alert_type_key, 1 AS alert_count,
  'Machine ' || machine_id || ' raised ' || c.alert_code AS message
FROM (SELECT *, lag(event_time) OVER (PARTITION BY machine_id, alert_code ORDER BY event_time, reading_id) AS prev FROM candidates) c
JOIN dim_alert_type a ON a.alert_code = c.alert_code
WHERE prev IS NULL OR event_time - prev > {REARM}""",
    "alerts": """
SELECT reading_id, date_key, time_key, machine_key, machine_id, r.alert_type_key, shift_key, event_time AS raised_at, alert_count,
  trigger_value, threshold_value, message,
  CASE WHEN reading_id % 3 = 0 THEN event_time + INTERVAL 10 MINUTE END AS acknowledged_at,
  CASE WHEN reading_id % 3 = 0 THEN event_time + INTERVAL 25 MINUTE END AS resolved_at,
  CASE WHEN reading_id % 3 = 0 THEN 'operator' || CAST(reading_id % 7 AS VARCHAR) || '@contoso.com' END AS acknowledged_by,
  CASE WHEN reading_id % 3 = 0 THEN CAST(10 AS DOUBLE) END AS time_to_acknowledge_min,
  CASE WHEN reading_id % 3 = 0 THEN CAST(25 AS DOUBLE) END AS time_to_resolve_min,
  CASE WHEN reading_id % 3 = 0 THEN 10 > a.sla_response_minutes END AS breached_sla,
  reading_id % 3 <> 0 AS is_open, a.severity, a.alert_name, a.alert_category
FROM raised r JOIN dim_alert_type a ON a.alert_type_key = r.alert_type_key""",
    "stop_changes": """
SELECT *, lead(event_time) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS ended_at
FROM (SELECT *, lag(down) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS was_down
      FROM (SELECT *, coalesce(is_downtime, FALSE) OR upper(status) IN ('DOWN', 'FAULT') AS down FROM conformed))
WHERE down <> coalesce(was_down, FALSE)""",
    "stops": """
SELECT date_key, time_key, machine_key, status_key, shift_key, machine_id, event_time AS started_at, ended_at,
  round((epoch_us(ended_at) - epoch_us(event_time)) / 6e7, 2) AS duration_minutes,
  coalesce(is_planned_downtime, FALSE) AS is_planned, upper(status) AS reason_code, ended_at IS NULL AS is_open
FROM stop_changes WHERE down""",
    "failure_alerts": """
SELECT reading_id AS alert_id, machine_id, event_time,
  CASE WHEN status = 'FAULT' THEN 'FAULT_STATUS' WHEN temperature_c >= 85 THEN 'HIGH_TEMP' ELSE 'HIGH_VIBRATION' END AS alert_type,
  CASE WHEN status = 'FAULT' THEN 'CRITICAL' WHEN temperature_c >= 85 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  CASE WHEN status = 'FAULT' THEN 'Machine ' || machine_id || ' reported FAULT status'
       WHEN temperature_c >= 85 THEN 'Temperature ' || CAST(temperature_c AS VARCHAR) || 'C exceeds threshold'
       ELSE 'Vibration ' || CAST(vibration_mm_s AS VARCHAR) || 'mm/s exceeds threshold' END AS message,
  reading_id % 3 = 0 AS acknowledged
FROM readings WHERE status = 'FAULT' OR temperature_c >= 85 OR vibration_mm_s >= 5.0""",
    "downtime_events": """
SELECT reading_id AS event_id, machine_id, event_time AS start_time, end_time,
  round((epoch_us(end_time) - epoch_us(event_time)) / 6e7, 2) AS duration_minutes, status AS reason_code
FROM (SELECT *, lead(event_time) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS end_time
      FROM (SELECT *, status IN ('DOWN', 'FAULT') AS down,
              lag(status IN ('DOWN', 'FAULT')) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS was
            FROM readings)
      WHERE down <> coalesce(was, FALSE))
WHERE down""",
    "days": """
SELECT CAST(unnest(generate_series((SELECT min(CAST(event_time AS DATE)) FROM readings),
  (SELECT max(CAST(event_time AS DATE)) FROM readings), INTERVAL 1 DAY)) AS DATE) AS full_date""",
    "planned": "SELECT machine_id, full_date AS production_date, 480 AS planned_minutes FROM master, days",
    "line_output": """
SELECT l_suppkey AS machine_key, CAST(l_shipdate AS DATE) AS full_date, CAST(l_quantity AS INTEGER) AS units,
  CAST(l_quantity AS INTEGER) - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS good,
  600 + 40 * CAST(l_quantity AS INTEGER) AS run, 60 * l_linenumber AS pstop, 10 + l_suppkey % 30 AS ideal
FROM lineitem""",
    "line_days": """
SELECT full_date, CAST(sum(units) AS BIGINT) AS u, CAST(sum(good) AS BIGINT) AS g, CAST(sum(run) AS BIGINT) AS r, CAST(sum(pstop) AS BIGINT) AS s,
  60 * count(*) AS p, CAST(sum(units * ideal) AS BIGINT) AS i FROM line_output GROUP BY ALL""",
    "line_axis": """
SELECT CAST(unnest(generate_series((SELECT min(full_date) FROM line_days), (SELECT max(full_date) FROM line_days), INTERVAL 1 DAY)) AS DATE) AS full_date""",
    "line_all_days": "SELECT full_date, u, g, r, s, p, i FROM line_axis LEFT JOIN line_days USING (full_date)",
    # ---- components of the measures, per machine-hour joined to its machine ----
    "cells": """
SELECT h.*, m.ideal_cycle_time_sec, m.machine_id, m.machine_name, m.machine_type, m.production_line, m.plant_code,
  CAST(h.window_start AS DATE) AS full_date
FROM hourly h LEFT JOIN dim_machine m ON m.machine_key = h.machine_key""",
}


def parts(group: str, source: str = "cells", where: str = "") -> str:
    """Summed production components by the given columns."""
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}count(*) AS c_readings, CAST(sum(units_produced) AS BIGINT) AS c_units,
  CAST(sum(good_units) AS BIGINT) AS c_good, CAST(sum(scrap_units) AS BIGINT) AS c_scrap,
  CAST(sum(runtime_seconds) AS BIGINT) AS c_run, CAST(sum(idle_seconds) AS BIGINT) AS c_idle,
  CAST(sum(downtime_seconds) AS BIGINT) AS c_down, CAST(sum(planned_stop_seconds) AS BIGINT) AS c_pstop,
  sum(planned_minutes) AS c_planned, CAST(sum(kw_seconds) AS DOUBLE) AS c_kws, CAST(sum(temp_sum) AS DOUBLE) AS c_temp,
  CAST(sum(reading_count) AS BIGINT) AS c_n, CAST(sum(units_produced * ideal_cycle_time_sec) AS DOUBLE) AS c_ideal,
  CAST(max(max_temperature_c) AS DOUBLE) AS c_max, CAST(sum(CAST(avg_vibration_mm_s AS DECIMAL(20,9))) AS DOUBLE) / count(avg_vibration_mm_s) AS c_vib, max(window_end) AS c_end,
  count(DISTINCT machine_key) AS c_machines
FROM {source} {where} {by}"""


A = "least((CAST(c_run AS DOUBLE) / 60) / nullif(c_planned - CAST(c_pstop AS DOUBLE) / 60, 0), 1.0)"
P = "least(c_ideal / nullif(CAST(c_run AS DOUBLE), 0), 1.0)"
Q = "(CAST(c_good AS DOUBLE) / nullif(CAST(c_units AS DOUBLE), 0))"
OEE = f"({A} * {P} * {Q})"


def total(c: str, digits: int = 9) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(20,{digits}))) AS DOUBLE)"


def mean(c: str, digits: int = 9) -> str:
    return f"{total(c, digits)} / CAST(count({c}) AS DOUBLE)"


def line_oee(over: str = "") -> str:
    """OEE from the summed day columns, optionally windowed sums."""
    t = lambda c: f"CAST(sum({c}) {over} AS DOUBLE)" if over else f"CAST({c} AS DOUBLE)"
    return (f"least(({t('r')} / 60) / nullif({t('p')} - {t('s')} / 60, 0), 1.0) * "
            f"least({t('i')} / nullif({t('r')}, 0), 1.0) * ({t('g')} / nullif({t('u')}, 0))")


def stop_parts(group: str, source: str = "stops") -> str:
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}count(*) AS c_stops, CAST(sum(CAST(duration_minutes AS DECIMAL(18,2))) AS DOUBLE) AS c_stop_min,
  count(*) FILTER (WHERE is_open) AS c_open,
  CAST(sum(CAST(duration_minutes AS DECIMAL(18,2))) FILTER (WHERE NOT is_planned) AS DOUBLE) AS c_unplanned
FROM {source} {by}"""


def alert_parts(group: str, source: str = "alerts") -> str:
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}count(*) AS c_alerts,
  nullif(count(*) FILTER (WHERE is_open), 0) AS c_active, nullif(count(*) FILTER (WHERE severity = 'CRITICAL'), 0) AS c_crit,
  sum(time_to_acknowledge_min) AS c_ack, count(time_to_acknowledge_min) AS c_acked, count(acknowledged_at) AS c_acknowledged,
  count(*) FILTER (WHERE NOT breached_sla) AS c_in_sla, max(raised_at) AS c_newest
FROM {source} {by}"""


def complete(body: str) -> str:
    """Body with the relations it needs, each once and in dependency order."""
    order: list[str] = []
    open_: set[str] = set()

    def visit(text: str) -> None:
        words = set(re.findall(r"\w+", re.sub(r"'[^']*'", "", text)))
        for name in RELATIONS:
            if name in words and name not in order and name not in open_:
                open_.add(name)
                visit(RELATIONS[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in order)
    text = body.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {head},\n{text[5:]}"
    return f"WITH {head}\n{text}"
