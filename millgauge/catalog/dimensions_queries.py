"""Dimension builds, keyed merges, history and migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dimensions, downtime, merge, production, scd2
from ..operators.joins import as_of_version
from ..plans import migration
from ..sources import seeds, sinks
from ..sources.store import Store
from . import sql
from .aggregates import HOURLY_OUT, HOURLY_SQL, ROLLUP_OUT, ROLLUP_SQL
from .expressions import CALENDAR_SQL, CLOCK_SQL, PLANNED_REASON
from .joins import STALE_SQL, stale_copy
from .registry import Context, query
from .versions import CHANGED_AT, changed_master, versions


# ---- dimensions, each with the facts that use it ----------------------------------
@query("dim1", f"""SELECT full_date, {CALENDAR_SQL}, coalesce(n, 0) AS orders FROM (SELECT CAST(unnest(generate_series((SELECT CAST(min(o_orderdate) AS DATE) FROM orders),
  (SELECT CAST(max(o_orderdate) AS DATE) FROM orders), INTERVAL 1 DAY)) AS DATE) AS full_date) s
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d2, count(*) AS n FROM orders GROUP BY ALL) o ON o.d2 = full_date, LATERAL (SELECT full_date AS d) x""")
def dim_date(x: Context):
    per = x.table("orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count("*").alias("n"))
    dates = dimensions.dates_of(dimensions.date_span(per, "full_date"))
    return dates.join(per, "full_date", "left").select(*dates.columns, F.coalesce("n", F.lit(0)).alias("orders"))


@query("dim2", f"""SELECT {CLOCK_SQL}, coalesce(n, 0) AS readings FROM (SELECT range AS m, TIMESTAMP '2000-01-01' + to_minutes(range) AS t FROM range(1440))
LEFT JOIN (SELECT hour(event_time) * 60 + minute(event_time) AS k, count(*) AS n FROM readings GROUP BY ALL) ON k = m""")
def dim_time(x: Context):
    per = x.star.sensor.groupBy("time_key").agg(F.count("*").alias("n"))
    dim = x.star.minutes_of_day
    return dim.join(per, "time_key", "left").select(*dim.columns, F.coalesce("n", F.lit(0)).alias("readings"))


@query("dim3", """SELECT s.shift_key, shift_code, shift_name, start_time, end_time, s.planned_minutes, crosses_midnight, coalesce(n, 0) AS readings
FROM dim_shift s LEFT JOIN (SELECT shift_key, count(*) AS n FROM sensor GROUP BY ALL) u ON u.shift_key = s.shift_key""")
def dim_shift(x: Context):
    per = x.star.sensor.groupBy("shift_key").agg(F.count("*").alias("n"))
    return x.star.shifts.join(per, "shift_key", "left").select(*x.star.shifts.columns, F.coalesce("n", F.lit(0)).alias("readings"))


@query("dim4", """SELECT s.status_key, status_code, status_name, status_category, is_productive, is_downtime, is_planned_downtime, counts_toward_oee,
  display_colour_hex, sort_order, coalesce(n, 0) AS readings
FROM dim_status s LEFT JOIN (SELECT status_key AS k, count(*) AS n FROM sensor GROUP BY ALL) u ON k = s.status_key""")
def dim_status(x: Context):
    per = x.star.sensor.groupBy("status_key").agg(F.count("*").alias("n"))
    return x.star.statuses.join(per, "status_key", "left").select(*x.star.statuses.columns, F.coalesce("n", F.lit(0)).alias("readings"))


@query("dim5", """SELECT a.alert_type_key, a.alert_code, a.alert_name, a.alert_category, a.severity, a.severity_rank, a.sla_response_minutes, a.requires_shutdown, a.display_colour_hex, coalesce(n, 0) AS raised_alerts
FROM dim_alert_type a LEFT JOIN (SELECT alert_type_key AS k, count(*) AS n FROM alerts GROUP BY ALL) u ON k = a.alert_type_key""")
def dim_alert_type(x: Context):
    per = x.star.alerts.groupBy("alert_type_key").agg(F.count("*").alias("n"))
    dim = x.star.alert_types
    return dim.join(per, "alert_type_key", "left").select(*dim.columns, F.coalesce("n", F.lit(0)).alias("raised_alerts"))


sql.RELATIONS["dim_flags"] = sql._seed(seeds.FLAG_COLUMNS, seeds.FLAGS)


@query("dim6", """SELECT f.flags_key, is_outlier, is_backfilled, is_estimated, flag_description, coalesce(n, 0) AS readings FROM dim_flags f
LEFT JOIN (SELECT flags_key AS k, count(*) AS n FROM sensor GROUP BY ALL) u ON k = f.flags_key""")
def dim_flags(x: Context):
    per = x.star.sensor.groupBy("flags_key").agg(F.count("*").alias("n"))
    dim = seeds.reading_flags(x.spark)
    return dim.join(per, "flags_key", "left").select(*dim.columns, F.coalesce("n", F.lit(0)).alias("readings"))


_MACHINE_OUT = ("machine_key", "machine_id", "machine_name", "machine_type", "production_line", "plant_code",
                "criticality", "is_inferred")


@query("dim7", """SELECT m.machine_key, m.machine_id, machine_name, machine_type, production_line, plant_code, criticality, is_inferred, coalesce(n, 0) AS readings
FROM dim_machine m LEFT JOIN (SELECT machine_key AS k, count(*) AS n FROM sensor GROUP BY ALL) u ON k = m.machine_key""")
def dim_machine(x: Context):
    known = dimensions.load_machines(x.star.master.where("machine_type = 'CNC'"))
    dim = dimensions.load_machines(x.star.master, known)
    per = x.star.sensor.groupBy("machine_key").agg(F.count("*").alias("n"))
    return dim.join(per, "machine_key", "left").select(*_MACHINE_OUT, F.coalesce("n", F.lit(0)).alias("readings"))


@query("dim8", f"""SELECT machine_key, machine_id, machine_name, machine_type, production_line, plant_code, criticality, is_inferred FROM dim_machine
UNION ALL SELECT {sql.key("machine_id || '|1970-01-01 00:00:00'")}, machine_id, machine_id, 'UNKNOWN', 'UNASSIGNED', 'PLANT-01', 'MEDIUM', TRUE
FROM (SELECT DISTINCT machine_id FROM readings) WHERE machine_id NOT IN (SELECT machine_id FROM dim_machine)""")
def inferred(x: Context):
    return dimensions.infer_machines(x.star.machines, x.readings).select(*_MACHINE_OUT)


@query("dim9", """SELECT v.machine_id, v.machine_name AS current_machine_name, v.machine_type AS current_machine_type, m.machine_name AS source_machine_name,
  m.machine_type AS source_machine_type, count(r.reading_id) AS readings FROM versions v JOIN master m ON m.machine_id = v.machine_id JOIN readings r ON r.machine_id = v.machine_id
WHERE v.is_current AND (v.machine_name IS DISTINCT FROM m.machine_name OR v.machine_type IS DISTINCT FROM m.machine_type) GROUP BY ALL""")
def drift(x: Context):
    per = x.readings.groupBy("machine_id").agg(F.count("*").alias("readings"))
    return scd2.drift(versions(x), x.star.master).join(per, "machine_id")


@query("dim10", """SELECT v.machine_key, v.machine_id, v.machine_name, v.production_line, v.valid_from, v.valid_to, v.is_current, count(r.reading_id) AS readings
FROM versions v LEFT JOIN readings r ON r.machine_id = v.machine_id AND r.event_time >= v.valid_from AND r.event_time < v.valid_to GROUP BY ALL""")
def history(x: Context):
    dim = versions(x)
    per = as_of_version(x.readings, dim.select("machine_id", "machine_key", "valid_from", "valid_to"), "machine_id",
                        "event_time").groupBy("machine_key").agg(F.count("*").alias("n"))
    return dim.join(per, "machine_key", "left").select("machine_key", "machine_id", "machine_name", "production_line", "valid_from",
                                                       "valid_to", "is_current", F.coalesce("n", F.lit(0)).alias("readings"))


@query("dim10_twice", """SELECT v.machine_id, count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_rows, (SELECT count(*) FROM readings) AS readings
FROM versions v GROUP BY ALL""")
def history_replayed(x: Context):
    """Applying the same change again adds nothing."""
    at = F.lit(CHANGED_AT).cast("timestamp")
    twice = scd2.apply_versions(versions(x), changed_master(x), at)
    n = x.readings.agg(F.count("*").alias("readings"))
    return twice.groupBy("machine_id").agg(F.count("*").alias("versions"), F.count_if("is_current").alias("current_rows")).crossJoin(n)


@query("dim11", "SELECT machine_id, production_date, planned_minutes FROM planned")
def planned(x: Context):
    return x.star.planned_time


# ---- merges -------------------------------------------------------------------
def _unit_rows(df):
    return df.select("machine_key", "window_start", "units_produced", "good_units")


def stored(x: Context, df, ts: str = "window_start", unit: str = "yyyyMMdd") -> Store:
    """Rows as a stored table of days."""
    out = Store.like(df, x.path("stored"), ts, unit)
    out.overwrite(df)
    return out


@query("mrg1", f"""WITH {STALE_SQL} SELECT machine_key, window_start, units_produced, good_units FROM stale
UNION ALL SELECT machine_key, window_start, units_produced, good_units FROM hourly h WHERE NOT EXISTS (SELECT 1 FROM stale s WHERE s.machine_key = h.machine_key AND s.window_start = h.window_start)""")
def insert_ignore(x: Context):
    table = stored(x, _unit_rows(stale_copy(x)))
    table.insert_ignore(_unit_rows(x.star.hourly), production.GRAIN)
    return table.read()


@query("mrg2", "SELECT machine_key, window_start, units_produced, good_units FROM hourly")
def upsert(x: Context):
    table = stored(x, _unit_rows(stale_copy(x)))
    table.upsert(_unit_rows(x.star.hourly), production.GRAIN)
    return table.read()


@query("mrg2_days", f"""WITH {STALE_SQL}, changed AS (SELECT strftime(h.window_start, '%Y%m%d') AS part,
  s.machine_key IS NOT NULL AS known FROM hourly h LEFT JOIN stale s USING (machine_key, window_start)
  WHERE s.machine_key IS NULL OR h.units_produced IS DISTINCT FROM s.units_produced OR h.good_units IS DISTINCT FROM s.good_units)
SELECT part, coalesce(bool_or(known), FALSE) AS rewritten, count(known) > 0 AS touched
FROM (SELECT DISTINCT strftime(window_start, '%Y%m%d') AS part FROM hourly) LEFT JOIN changed USING (part) GROUP BY part""")
def upsert_days(x: Context):
    """Which days a merge rewrites, which only gain a folder, and that the same merge again does neither."""
    table = stored(x, _unit_rows(stale_copy(x)))
    before = table.manifest().groups
    for _ in range(2):
        table.upsert(_unit_rows(x.star.hourly), production.GRAIN)
    after = table.manifest().groups
    rows = [(p, bool(set(before.get(p, [])) - set(g)), before.get(p) != g) for p, g in after.items()]
    return x.spark.createDataFrame(rows, "part string, rewritten boolean, touched boolean")


@query("mrg3", HOURLY_SQL)
def accumulate(x: Context):
    """The accumulated hours plus a late slice of readings, which arrives twice and counts once."""
    cut = x.newest("cut").select((F.col("cut") - F.expr("INTERVAL 90 MINUTES")).alias("cut"))
    split = x.star.conformed.crossJoin(F.broadcast(cut))
    table = stored(x, production.hourly_components(split.where(F.col("event_time") <= F.col("cut"))))
    late = production.hourly_components(split.where(F.col("event_time") > F.col("cut")))
    for _ in range(2):
        table.accumulate(late, production.GRAIN, production.merge_components, "late", 0)
    return production.finish_hourly(table.read()).select(*HOURLY_OUT)


@query("mrg3_recompute", "SELECT machine_key, window_start, units_produced, good_units FROM hourly")
def recompute_touched(x: Context):
    """Replay-safe form: hours that a batch touches are computed again from the atomic
    rows and replace what was there; doing it twice changes nothing."""
    atomic = x.star.conformed.withColumn("window_start", F.date_trunc("hour", "event_time"))
    batch = atomic.crossJoin(F.broadcast(x.newest())).where(
        F.col("event_time") > F.col("as_of") - F.expr("INTERVAL 90 MINUTES"))
    fresh = _unit_rows(production.hourly_fact(merge.touched_grain(atomic, batch, production.GRAIN).drop("window_start")))
    table = stored(x, _unit_rows(stale_copy(x)))
    for _ in range(2):
        table.upsert(fresh, production.GRAIN)
    return table.read()


@query("mrg4", """SELECT machine_id, started_at, ended_at, duration_minutes, is_open FROM stops""")
def guarded_update(x: Context):
    """Every stop first stored as open, then closed by the ends; open ones stay open, closed ones stay as they are."""
    full = x.star.downtime.select("machine_id", "started_at", "ended_at", "duration_minutes", "is_open")
    table = stored(x, downtime.as_open(full.select("machine_id", "started_at")), "started_at")
    ends = full.where("ended_at IS NOT NULL")
    wrong = ends.withColumn("duration_minutes", F.lit(-1.0))
    for rows in (ends, wrong):
        table.update(rows, ("machine_id", "started_at"), ("ended_at", "duration_minutes", "is_open"), F.col("is_open"))
    return table.read()


@query("mrg5", """SELECT machine_key, window_start, units_produced, good_units FROM hourly WHERE machine_key <> -1""")
def delete_orphans(x: Context):
    table = stored(x, _unit_rows(x.star.hourly))
    table.drop_orphans(x.star.hourly.where("machine_key <> -1"), production.GRAIN)
    return table.read()


def lines_by_month(x: Context) -> Store:
    return stored(x, x.table("lineitem").select(F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), "l_quantity"), "l_shipdate", "yyyyMM")


_RETENTION = {"as_of": "1998-01-15", "months": 24}


@query("mrg6", """SELECT strftime(l_shipdate, '%Y%m') AS event_month, count(*) AS rows FROM lineitem
WHERE CAST(date_trunc('month', l_shipdate) AS DATE) >= DATE '1996-01-01' GROUP BY ALL""")
def retention(x: Context):
    """Old months leave the table and the disk; the others are not touched."""
    table = lines_by_month(x)
    table.drop_expired(F.lit(_RETENTION["as_of"]).cast("date"), _RETENTION["months"])
    return table.read().groupBy(F.date_format("l_shipdate", "yyyyMM").alias("event_month")).agg(F.count("*").alias("rows"))


_EXPIRED_SQL = """SELECT DISTINCT strftime(l_shipdate, '%Y%m') AS event_month FROM lineitem WHERE CAST(date_trunc('month', l_shipdate) AS DATE) < DATE '1996-01-01'"""


@query("mrg6_preview", _EXPIRED_SQL)
def retention_preview(x: Context):
    """From the catalogue of the stored table; no row is read."""
    names = lines_by_month(x).expired(F.lit(_RETENTION["as_of"]).cast("date"), _RETENTION["months"])
    return names.withColumnRenamed("part", "event_month")


@query("fn4", _EXPIRED_SQL)
def drop_partitions(x: Context):
    """Names of the partitions dropped."""
    gone = lines_by_month(x).drop_expired(F.lit(_RETENTION["as_of"]).cast("date"), _RETENTION["months"])
    return x.spark.createDataFrame([(p,) for p in gone], "event_month string")


@query("mrg7", """SELECT strftime(l_shipdate, '%Y%m') AS event_month, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ALL""")
def new_partitions(x: Context):
    """A month's partition appears with its first rows."""
    path = x.path("lines_by_month")
    rows = x.table("lineitem").select("l_shipdate", "l_quantity")
    sinks.write_monthly(rows, path, "l_shipdate")
    return x.spark.read.parquet(path).groupBy(F.col("event_month").cast("string").alias("event_month")).agg(
        F.count("*").alias("rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


# ---- migration ------------------------------------------------------------------
@query("mig1", """SELECT reading_id, date_key, time_key, machine_key, status_key, shift_key, flags_key, event_ts, CAST(temperature_c AS DOUBLE) AS temperature_c,
  units_produced, good_units, runtime_seconds FROM sensor""")
def backfill_sensor(x: Context):
    s = x.star
    return migration.backfill_sensor(s.readings, s.machines, s.statuses, s.minutes_of_day).select(
        "reading_id", "date_key", "time_key", "machine_key", "status_key", "shift_key", "flags_key", "event_ts",
        "temperature_c", "units_produced", "good_units", "runtime_seconds")


sql.RELATIONS["migrated_alerts"] = f"""
SELECT alert_id, {sql.keys_of('event_time')}, coalesce(m.machine_key, -1) AS machine_key, a.alert_type_key, event_time AS raised_at,
  CASE WHEN acknowledged THEN event_time + INTERVAL 10 MINUTE END AS acknowledged_at,
  CASE WHEN acknowledged THEN event_time + INTERVAL 25 MINUTE END AS resolved_at, message, a.sla_response_minutes
FROM (SELECT *, lag(event_time) OVER (PARTITION BY machine_id, alert_type ORDER BY event_time, alert_id) AS p FROM failure_alerts) f
LEFT JOIN dim_machine m ON m.machine_id = f.machine_id JOIN dim_alert_type a ON a.alert_code = f.alert_type
WHERE p IS NULL OR event_time - p > INTERVAL 60 MINUTE"""


def migrated_alerts(x: Context):
    s = x.facts
    return migration.backfill_alerts(s.failure_alerts, s.machines, s.alert_types, s.minutes_of_day, 60)


@query("mig2", "SELECT alert_id, date_key, time_key, shift_key, machine_key, alert_type_key, raised_at, acknowledged_at, resolved_at, message FROM migrated_alerts")
def backfill_alerts(x: Context):
    return migrated_alerts(x).drop("alert_count")


@query("mig3", """SELECT alert_id, CASE WHEN acknowledged_at IS NOT NULL THEN CAST(10 AS DOUBLE) END AS time_to_acknowledge_min,
  CASE WHEN acknowledged_at IS NOT NULL THEN CAST(25 AS DOUBLE) END AS time_to_resolve_min,
  CASE WHEN acknowledged_at IS NOT NULL THEN 10 > sla_response_minutes END AS breached_sla FROM migrated_alerts""")
def service_level(x: Context):
    from ..operators.alerts import evaluate_sla

    return evaluate_sla(migrated_alerts(x), x.star.alert_types).select(
        "alert_id", "time_to_acknowledge_min", "time_to_resolve_min", "breached_sla")


def migrated_stops(x: Context):
    s = x.facts
    return migration.backfill_downtime(s.downtime_events, s.machines, s.statuses, s.minutes_of_day, x.newest())


@query("mig4", f"""SELECT event_id, machine_key, started_at, ended_at, coalesce(duration_minutes, (epoch_us(coalesce(ended_at, as_of)) - epoch_us(started_at)) / 6e7) AS duration_minutes,
  CAST(4 AS SMALLINT) AS status_key, {PLANNED_REASON.format(c='reason_code')} AS is_planned FROM (SELECT event_id, coalesce(m.machine_key, -1) AS machine_key, start_time AS started_at, end_time AS ended_at, duration_minutes, reason_code, as_of
FROM downtime_events e LEFT JOIN dim_machine m ON m.machine_id = e.machine_id, newest)""")
def backfill_downtime(x: Context):
    return migrated_stops(x).select("event_id", "machine_key", "started_at", "ended_at", "duration_minutes", "status_key", "is_planned")


_DAILY_SHARE = "coalesce(CAST(max(p.planned_minutes) AS DOUBLE) / 24, CAST(60 AS DOUBLE))"


@query("mig5", ROLLUP_SQL.format(planned=_DAILY_SHARE))
def backfill_hourly(x: Context):
    return migration.backfill_hourly(x.star.minute_kpis, x.star.machines, x.star.planned_time).select(*ROLLUP_OUT)


@query("mig6", """SELECT 'source readings' AS metric, CAST(count(*) AS DOUBLE) AS value FROM readings
UNION ALL SELECT 'target fact_sensor_reading', count(*) FROM sensor UNION ALL SELECT 'unknown machine_key rows', count(*) FROM sensor WHERE machine_key = -1
UNION ALL SELECT 'unknown status_key rows', count(*) FROM sensor WHERE status_key = -1 UNION ALL SELECT 'source failure_alerts', count(*) FROM failure_alerts
UNION ALL SELECT 'target fact_alert', count(*) FROM migrated_alerts UNION ALL SELECT 'source downtime_events', count(*) FROM downtime_events
UNION ALL SELECT 'target fact_downtime', count(*) FROM downtime_events UNION ALL SELECT 'source machine_kpi_1min', count(*) FROM minutes
UNION ALL SELECT 'target fact_production_hourly', count(*) FROM (SELECT DISTINCT machine_id, date_trunc('hour', window_start) FROM minutes)
UNION ALL SELECT 'alert dedup reduction pct', round(CAST(100 * ((SELECT count(*) FROM failure_alerts) - (SELECT count(*) FROM migrated_alerts)) AS DOUBLE) / (SELECT count(*) FROM failure_alerts), 2)""")
def reconciliation(x: Context):
    """Over the stored tables of both generations; each is read once."""
    s = x.facts
    sensor = x.kept("migrated_sensor", lambda: migration.backfill_sensor(s.readings, s.machines, s.statuses, s.minutes_of_day), "event_ts")
    hourly = x.kept("migrated_hourly", lambda: migration.backfill_hourly(s.minute_kpis, s.machines, s.planned_time), "window_start")
    alerts = x.kept("migrated_alerts", lambda: migrated_alerts(x), "raised_at")
    stops = x.kept("migrated_stops", lambda: migrated_stops(x), "started_at")
    return migration.reconciliation(s, sensor, alerts, stops, hourly)


@query("mig7", """SELECT machine_id, CAST(episode AS BIGINT) AS episode, min(start_time) AS started_at, max(coalesce(end_time, start_time)) AS ended_at, count(*) AS raw_events FROM (
SELECT *, sum(CASE WHEN p IS NULL OR start_time - p > INTERVAL 300 SECOND THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id ORDER BY start_time, event_id) AS episode
FROM (SELECT *, max(coalesce(end_time, start_time)) OVER (PARTITION BY machine_id ORDER BY start_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM downtime_events)) GROUP BY ALL""")
def consolidate(x: Context):
    return migration.consolidate(x.facts.downtime_events)

