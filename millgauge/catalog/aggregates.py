"""Aggregations, windows, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import num, ratio
from ..operators import production, quality
from ..operators.sequence import count_starts, episodes, first_per, gap_starts, newest_per, ordered_columns
from ..plans import reports
from ..plans.measures import theoretical_minutes_per_machine
from .registry import Context, query

HOURLY_OUT = ("machine_key", "window_start", "window_end", "date_key", "time_key", "shift_key", "reading_count",
              "units_produced", "good_units", "scrap_units", "runtime_minutes", "idle_minutes", "downtime_minutes",
              "planned_minutes", "energy_kwh", "avg_temperature_c", "max_temperature_c", "temp_sum",
              "avg_vibration_mm_s", "max_vibration_mm_s")
HOURLY_SQL = """SELECT machine_key, window_start, window_end, date_key, time_key, shift_key, reading_count, units_produced, good_units,
  scrap_units, runtime_minutes, idle_minutes, downtime_minutes, planned_minutes, energy_kwh, avg_temperature_c,
  CAST(max_temperature_c AS DOUBLE) AS max_temperature_c, CAST(temp_sum AS DOUBLE) AS temp_sum, avg_vibration_mm_s,
  CAST(max_vibration_mm_s AS DOUBLE) AS max_vibration_mm_s FROM hourly"""
MINUTE_OUT = ("machine_id", "window_start", "window_end", "avg_temperature_c", "max_temperature_c", "avg_power_kw",
              "total_power_kwh", "running_seconds", "idle_seconds", "down_seconds", "units_produced", "good_units")
MINUTE_SQL = """SELECT machine_id, window_start, window_end, avg_temperature_c, CAST(max_temperature_c AS DOUBLE) AS max_temperature_c,
  avg_power_kw, total_power_kwh, running_seconds, idle_seconds, down_seconds, units_produced, good_units FROM minutes"""
ROLLUP_SQL = """SELECT coalesce(m.machine_key, -1) AS machine_key, k.machine_id, date_trunc('hour', k.window_start) AS window_start,
  count(*) AS minute_count, CAST(sum(k.units_produced) AS BIGINT) AS units_produced, CAST(sum(k.good_units) AS BIGINT) AS good_units,
  CAST(sum(k.running_seconds) AS DOUBLE) / 60 AS runtime_minutes, CAST(sum(k.down_seconds) AS DOUBLE) / 60 AS downtime_minutes,
  CAST(sum(k.power_sum) AS DOUBLE) / 60 AS energy_kwh, CAST(sum(k.temp_sum) AS DOUBLE) / CAST(sum(k.reading_count) AS DOUBLE) AS avg_temperature_c,
  {planned} AS planned_minutes
FROM minutes k LEFT JOIN dim_machine m ON m.machine_id = k.machine_id
LEFT JOIN planned p ON p.machine_id = k.machine_id AND p.production_date = CAST(k.window_start AS DATE) GROUP BY ALL"""
ROLLUP_OUT = ("machine_key", "machine_id", "window_start", "minute_count", "units_produced", "good_units",
              "runtime_minutes", "downtime_minutes", "energy_kwh", "avg_temperature_c", "planned_minutes")


@query("ag1", HOURLY_SQL)
def hourly(x: Context):
    return x.star.hourly.select(*HOURLY_OUT)


@query("ag2", MINUTE_SQL)
def minutes(x: Context):
    return x.star.minute_kpis.select(*MINUTE_OUT)


@query("ag3", ROLLUP_SQL.format(planned="CAST(60 AS DOUBLE)"))
def rollup(x: Context):
    return production.rollup_minutes(x.star.minute_kpis, x.star.machines, x.star.planned_time).select(*ROLLUP_OUT)


@query("ag4", """SELECT machine_id, CAST(sum(temperature_c) FILTER (WHERE status = 'RUNNING') AS DOUBLE) / count(temperature_c) FILTER (WHERE status = 'RUNNING') AS avg_running,
  CAST(max(temperature_c) FILTER (WHERE status = 'FAULT') AS DOUBLE) AS max_fault, count(*) FILTER (WHERE status = 'IDLE') AS idle FROM readings GROUP BY ALL""")
def filtered(x: Context):
    on = lambda agg, cond: F.expr(f"{agg} FILTER (WHERE {cond})")
    return x.readings.groupBy("machine_id").agg(
        ratio(on("sum(temperature_c)", "status = 'RUNNING'"), on("count(temperature_c)", "status = 'RUNNING'")).alias("avg_running"),
        num(on("max(temperature_c)", "status = 'FAULT'")).alias("max_fault"),
        on("count(*)", "status = 'IDLE'").alias("idle"))


@query("ag5", """SELECT machine_id, count(*) FILTER (WHERE temperature_c > 85) AS hot,
  CAST(sum(CASE WHEN upper(status) = 'RUNNING' THEN 5 ELSE 0 END) AS BIGINT) AS running_seconds FROM readings GROUP BY ALL""")
def conditional(x: Context):
    return x.readings.groupBy("machine_id").agg(
        F.count_if(F.col("temperature_c") > 85).alias("hot"),
        F.sum(F.when(F.upper("status") == "RUNNING", 5).otherwise(0)).alias("running_seconds"))


@query("ag6", "SELECT machine_key, window_start, date_key, shift_key FROM hourly")
def constant_in_group(x: Context):
    return x.star.conformed.groupBy("machine_key", F.date_trunc("hour", "event_time").alias("window_start")).agg(
        F.min("date_key").alias("date_key"), F.min("shift_key").alias("shift_key"))


@query("ag7", """SELECT machine_id, reason_code, min(ended_at) AS ended_at FROM stops GROUP BY ALL""")
def earliest(x: Context):
    return x.star.downtime.groupBy("machine_id", "reason_code").agg(F.min("ended_at").alias("ended_at"))


@query("ag8", "SELECT DISTINCT machine_id, upper(status) AS status FROM readings")
def distinct(x: Context):
    return x.readings.select("machine_id", F.upper("status").alias("status")).distinct()


@query("ag9", """SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY ALL HAVING count(*) > 30""")
def having(x: Context):
    return x.table("lineitem").groupBy("l_partkey").agg(F.count("*").alias("lines")).where("lines > 30")


@query("ag10", """SELECT coalesce(string_agg(machine_id, ', ' ORDER BY machine_id), '') AS machines,
  coalesce(string_agg(machine_id, ', ' ORDER BY machine_id) FILTER (WHERE n < 0), '') AS none FROM (SELECT machine_id, count(*) AS n FROM readings GROUP BY ALL)""")
def text_list(x: Context):
    """Counted per machine first: the text grows with machines, not with readings."""
    per = x.readings.groupBy("machine_id").agg(F.count("*").alias("n"))
    return per.selectExpr("machine_id", "CASE WHEN n < 0 THEN machine_id END AS gone").agg(
        F.expr("coalesce(listagg(machine_id, ', ') WITHIN GROUP (ORDER BY machine_id), '')").alias("machines"),
        F.expr("coalesce(listagg(gone, ', ') WITHIN GROUP (ORDER BY gone), '')").alias("none"))


@query("ag11", """SELECT machine_id, min_by(status, (-n, status)) AS top_status FROM (
SELECT machine_id, status, count(*) AS n FROM readings GROUP BY ALL) GROUP BY ALL""")
def most_frequent(x: Context):
    counts = x.readings.groupBy("machine_id", "status").agg(F.count("*").alias("n"))
    return counts.groupBy("machine_id").agg(
        F.min_by("status", F.struct(-F.col("n"), F.col("status"))).alias("top_status"))


@query("ag12", """SELECT (SELECT count(*) FROM stops) AS stops, (SELECT count(*) FROM alerts) AS alerts,
  (SELECT max(window_end) FROM hourly) AS last_end""")
def scalars(x: Context):
    return x.star.downtime.agg(F.count("*").alias("stops")).crossJoin(
        x.star.alerts.agg(F.count("*").alias("alerts"))).crossJoin(
        x.star.hourly.agg(F.max("window_end").alias("last_end")))


@query("ag13", """SELECT count(*) AS stuck FROM stops, newest WHERE ended_at IS NULL AND as_of - started_at > INTERVAL 4 HOUR""")
def always_one_row(x: Context):
    rows = x.star.downtime.where("ended_at IS NULL").crossJoin(F.broadcast(x.newest()))
    return rows.where(F.col("as_of") - F.col("started_at") > F.expr("INTERVAL 4 HOURS")).agg(F.count("*").alias("stuck"))


@query("ag14", """SELECT machine_key, CAST(sum(temp_sum) AS DOUBLE) / CAST(sum(reading_count) AS DOUBLE) AS avg_temperature_c FROM hourly GROUP BY ALL""")
def weighted_mean(x: Context):
    return x.star.hourly.groupBy("machine_key").agg(ratio(F.sum("temp_sum"), F.sum("reading_count")).alias("avg_temperature_c"))


@query("ag15", """SELECT shift_key, CAST(sum(units_produced * ideal_cycle_time_sec) AS DOUBLE) / 60 AS theoretical_min FROM cells GROUP BY ALL""")
def sum_of_products(x: Context):
    return theoretical_minutes_per_machine(x.star.hourly, x.star.machines, ["shift_key"])


@query("ag16", """SELECT shift_key, avg(time_to_acknowledge_min) AS mtta FROM alerts WHERE time_to_acknowledge_min IS NOT NULL GROUP BY ALL""")
def filtered_mean(x: Context):
    return x.star.alerts.where("time_to_acknowledge_min IS NOT NULL").groupBy("shift_key").agg(
        F.avg("time_to_acknowledge_min").alias("mtta"))


@query("ag17", HOURLY_SQL)
def additive_merge(x: Context):
    """Two partial aggregates of the same hours, merged, equal the aggregate of all readings."""
    part = lambda cond: production.hourly_components(x.star.conformed.where(cond))
    fast = F.col("status") == "RUNNING"
    return production.finish_hourly(production.merge_components(part(fast), part(~fast))).select(*HOURLY_OUT)


@query("ag18", """SELECT machine_id, CAST(window_start AS DATE) AS production_date, CAST(sum(running_seconds) AS BIGINT) AS running_seconds,
  CAST(sum(power_sum) AS DOUBLE) / 60 AS kwh FROM minutes GROUP BY ALL""")
def daily(x: Context):
    return x.star.minute_kpis.groupBy("machine_id", F.to_date("window_start").alias("production_date")).agg(
        F.sum("running_seconds").alias("running_seconds"), (num(F.sum("power_sum")) / 60).alias("kwh"))


@query("ag19", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in
                                 ("events", "lineitem", "orders", "customer", "supplier", "part", "nation", "region")))
def table_counts(x: Context):
    names = ("events", "lineitem", "orders", "customer", "supplier", "part", "nation", "region")
    return quality.row_counts({n: x.table(n) for n in names})


@query("ag20", """SELECT machine_id, shift_key, reason_code, CAST(grouping_id(machine_id, shift_key, reason_code) AS INTEGER) AS level,
  count(*) AS stops, CAST(sum(CAST(duration_minutes AS DECIMAL(18,2))) AS DOUBLE) AS downtime_min
FROM stops GROUP BY ROLLUP (machine_id, shift_key, reason_code)""")
def drill(x: Context):
    return reports.downtime_drill(x.star)


@query("ag20_line", """SELECT plant_code, production_line, machine_id, CAST(grouping_id(plant_code, production_line, machine_id) AS INTEGER) AS level,
  CAST(sum(units_produced) AS BIGINT) AS units FROM cells GROUP BY ROLLUP (plant_code, production_line, machine_id)""")
def drill_lines(x: Context):
    return reports.line_drill(x.star)


@query("ag23", """SELECT coalesce(a.machine_key, b.machine_key) AS machine_key, coalesce(a.date_key, b.date_key) AS date_key, units_hourly, good_hourly, readings_hourly,
  units_atomic, good_atomic, readings_atomic, CASE WHEN units_hourly = units_atomic AND good_hourly = good_atomic AND readings_hourly = readings_atomic THEN 'MATCH' ELSE 'MISMATCH' END AS verdict
FROM (SELECT machine_key, date_key, CAST(sum(units_produced) AS BIGINT) AS units_hourly, CAST(sum(good_units) AS BIGINT) AS good_hourly, CAST(sum(reading_count) AS BIGINT) AS readings_hourly FROM hourly GROUP BY ALL) a
FULL JOIN (SELECT machine_key, date_key, CAST(sum(units_produced) AS BIGINT) AS units_atomic, CAST(sum(good_units) AS BIGINT) AS good_atomic, count(*) AS readings_atomic FROM sensor GROUP BY ALL) b
ON a.machine_key = b.machine_key AND a.date_key = b.date_key""")
def aggregate_equivalence(x: Context):
    return quality.aggregate_matches(x.star.hourly, x.star.sensor)


# ---- windows ------------------------------------------------------------------
@query("wn1", """SELECT machine_id, alert_code, reading_id FROM (SELECT *, row_number() OVER (PARTITION BY machine_id, alert_code ORDER BY event_time, reading_id) AS rn FROM candidates) WHERE rn = 1""")
def first_row(x: Context):
    from ..operators.alerts import candidates

    rows = candidates(x.star.conformed).select("machine_id", "alert_code", "event_time", "reading_id")
    return first_per(rows, ["machine_id", "alert_code"], ["event_time", "reading_id"]).drop("event_time")


@query("wn2", """SELECT alert_id, lag(event_time) OVER (PARTITION BY machine_id, alert_type ORDER BY event_time, alert_id) AS prev_event_time FROM failure_alerts""")
def previous_time(x: Context):
    return ordered_columns(x.star.failure_alerts, ["machine_id", "alert_type"], "event_time", ["alert_id"],
                           lag={"prev_event_time": F.col("event_time")}).select("alert_id", "prev_event_time")


@query("wn3", """SELECT alert_id FROM (SELECT *, lag(event_time) OVER (PARTITION BY machine_id, alert_type ORDER BY event_time, alert_id) AS p FROM failure_alerts)
WHERE p IS NULL OR event_time - p > INTERVAL 5 MINUTE""")
def threshold_islands(x: Context):
    return gap_starts(x.star.failure_alerts, ["machine_id", "alert_type"], "event_time", ["alert_id"], 300).select("alert_id")


@query("wn4", """SELECT reading_id, status IN ('DOWN', 'FAULT') AS is_down, lag(status IN ('DOWN', 'FAULT')) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS prev_down FROM readings""")
def previous_flag(x: Context):
    down = x.readings.withColumn("is_down", F.col("status").isin("DOWN", "FAULT"))
    return ordered_columns(down, ["machine_id"], "event_time", ["reading_id"], lag={"prev_down": F.col("is_down")}).select(
        "reading_id", "is_down", "prev_down")


@query("wn5", """SELECT reading_id, last_value(CASE WHEN status = 'FAULT' THEN event_time END IGNORE NULLS) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_fault FROM readings""")
def running_last(x: Context):
    return ordered_columns(x.readings, ["machine_id"], "event_time", ["reading_id"],
                           last={"last_fault": F.when(F.col("status") == "FAULT", F.col("event_time"))}).select(
        "reading_id", "last_fault")


@query("wn6", """SELECT machine_id, episode, min(event_time) AS started_at, max(event_time) AS last_at, count(*) AS readings FROM (
SELECT *, CAST(sum(CASE WHEN down AND NOT coalesce(was, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS BIGINT) AS episode
FROM (SELECT *, lag(down) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS was FROM (SELECT *, status IN ('DOWN', 'FAULT') AS down FROM readings)))
WHERE down GROUP BY ALL""")
def group_islands(x: Context):
    down = x.readings.withColumn("down", F.col("status").isin("DOWN", "FAULT"))
    numbered = count_starts(down, ["machine_id"], "event_time", ["reading_id"], F.col("down"))
    return numbered.where("down").groupBy("machine_id", "episode").agg(
        F.min("event_time").alias("started_at"), F.max("event_time").alias("last_at"), F.count("*").alias("readings"))


@query("wn7", """SELECT machine_id, reading_id, status, event_time FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_time DESC, reading_id DESC) AS rn FROM readings) WHERE rn = 1""")
def newest_row(x: Context):
    rows = x.readings.select("machine_id", "reading_id", "status", "event_time")
    return newest_per(rows, ["machine_id"], ["event_time", "reading_id"])


@query("wn8", """SELECT machine_id, max(started_at) AS started_at FROM stops WHERE ended_at IS NULL GROUP BY ALL""")
def newest_open(x: Context):
    from ..operators.downtime import newest_open as newest

    return newest(x.star.downtime, start="started_at", end="ended_at").select("machine_id", "started_at")


@query("wn6_state", """SELECT machine_id, started_at, ended_at FROM stops""")
def state_islands(x: Context):
    from ..operators.downtime import is_down

    runs = episodes(x.star.conformed, ["machine_id"], "event_time", ["reading_id"], is_down())
    return runs.select("machine_id", F.col("event_time").alias("started_at"), "ended_at")


# ---- sort, limit, union ---------------------------------------------------------
@query("sl1", "SELECT started_at, machine_id FROM stops WHERE is_open ORDER BY started_at")
def sorted_rows(x: Context):
    return x.star.downtime.where("is_open").select("started_at", "machine_id").orderBy("started_at")


@query("sl2", """SELECT alert_id, event_time FROM failure_alerts ORDER BY event_time DESC, alert_id DESC LIMIT 5""")
def top_rows(x: Context):
    return x.star.failure_alerts.select("alert_id", "event_time").orderBy(F.desc("event_time"), F.desc("alert_id")).limit(5)


@query("so1", "SELECT reading_id, alert_code, trigger_value FROM candidates")
def tagged_union(x: Context):
    c = x.star.conformed
    part = lambda cond, code, v: c.where(cond).select("reading_id", F.lit(code).alias("alert_code"),
                                                      num(v).alias("trigger_value"))
    return (part(F.upper("status").isin("FAULT", "DOWN"), "FAULT_STATUS", "temperature_c")
            .unionByName(part(F.col("temperature_c") > 85, "HIGH_TEMP", "temperature_c"))
            .unionByName(part(F.col("vibration_mm_s") > 4.5, "HIGH_VIBRATION", "vibration_mm_s")))


@query("so2", """SELECT 'hours' AS metric, count(*) AS value FROM hourly UNION ALL SELECT 'stops', count(*) FROM stops
UNION ALL SELECT 'alerts', count(*) FROM alerts""")
def labelled_union(x: Context):
    return quality.row_counts({"hours": x.star.hourly, "stops": x.star.downtime, "alerts": x.star.alerts}).toDF("metric", "value")


@query("so3", """SELECT machine_id, max(daily_units) AS best_day FROM (SELECT machine_id, CAST(event_time AS DATE) AS d, CAST(sum(units_produced) AS BIGINT) AS daily_units
FROM readings GROUP BY ALL) GROUP BY ALL""")
def chained(x: Context):
    by_day = x.readings.groupBy("machine_id", F.to_date("event_time").alias("d")).agg(F.sum("units_produced").alias("daily_units"))
    return by_day.groupBy("machine_id").agg(F.max("daily_units").alias("best_day"))
