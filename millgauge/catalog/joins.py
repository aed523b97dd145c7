"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import production, quality
from ..operators.joins import as_of_version, denormalise, lookup, wildcard_members
from ..operators.sequence import newest_per
from ..plans import snowflake
from ..sources import seeds
from .registry import Context, query
from .versions import versions


@query("jn1", """SELECT r.reading_id, m.machine_name FROM readings r LEFT JOIN dim_machine m ON m.machine_id = r.machine_id""")
def left_lookup(x: Context):
    return lookup(x.readings, x.star.machines.select("machine_id", "machine_name"), "machine_id").select(
        "reading_id", "machine_name")


@query("jn2", "SELECT reading_id, status_key FROM conformed")
def expression_key(x: Context):
    return x.star.conformed.select("reading_id", "status_key")


@query("jn3", """SELECT r.reading_id, v.machine_key, v.production_line FROM readings r
LEFT JOIN versions v ON v.machine_id = r.machine_id AND v.is_current""")
def current_version(x: Context):
    dim = versions(x).where("is_current").select("machine_id", "machine_key", "production_line")
    return lookup(x.readings, dim, "machine_id").select("reading_id", "machine_key", "production_line")


@query("jn4", """SELECT reading_id, time_key, shift_key FROM conformed""")
def minute_key_join(x: Context):
    keyed = x.readings.withColumn("time_key", (F.hour("event_time") * 60 + F.minute("event_time")).cast("smallint"))
    return lookup(keyed, x.star.minutes_of_day.select("time_key", "shift_key"), "time_key").select(
        "reading_id", "time_key", "shift_key")


@query("jn5", """SELECT m.machine_type, sum(h.units_produced)::BIGINT AS units FROM hourly h
JOIN dim_machine m ON m.machine_key = h.machine_key GROUP BY ALL""")
def star_hop(x: Context):
    dim = x.star.machines.select("machine_key", "machine_type")
    return lookup(x.star.hourly, dim, "machine_key", "inner").groupBy("machine_type").agg(
        F.sum("units_produced").cast("bigint").alias("units"))


@query("jn6", """SELECT r_name, n_name, count(*) AS shipments, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def three_hops(x: Context):
    """The hops run over the aggregate per supplier, so the fact is not carried through them."""
    per_supplier = x.table("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    rows = lookup(per_supplier, x.table("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey", "inner")
    nation = x.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    rows = lookup(rows, nation, "s_nationkey", "inner")
    region = x.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    rows = lookup(rows, region, "n_regionkey", "inner")
    return rows.groupBy("r_name", "n_name").agg(F.sum("n").alias("shipments"), F.sum("q").alias("quantity"))


@query("jn7", """SELECT k.machine_id, k.window_start, p.planned_minutes FROM minutes k
LEFT JOIN planned p ON p.machine_id = k.machine_id AND p.production_date = CAST(k.window_start AS DATE)""")
def composite_key(x: Context):
    rows = x.star.minute_kpis.withColumn("production_date", F.to_date("window_start"))
    return lookup(rows, x.star.planned_time, ["machine_id", "production_date"]).select(
        "machine_id", "window_start", "planned_minutes")


@query("jn8", """SELECT event_id, s.status_key FROM downtime_events LEFT JOIN dim_status s ON s.status_code = 'FAULT'""")
def constant_join(x: Context):
    fault = x.star.statuses.where("status_code = 'FAULT'").select("status_key")
    return x.star.downtime_events.crossJoin(F.broadcast(fault)).select("event_id", "status_key")


@query("jn9", """SELECT c.reading_id, c.alert_code FROM candidates c WHERE NOT EXISTS (
  SELECT 1 FROM candidates e WHERE e.machine_id = c.machine_id AND e.alert_code = c.alert_code
  AND e.event_time < c.event_time AND e.event_time > c.event_time - INTERVAL 5 MINUTE)""")
def rearm_anti_join(x: Context):
    """The window of a candidate touches its own five-minute bucket and the one before,
    so the range becomes an equality on at most two buckets."""
    from ..operators.alerts import candidates

    span = 300_000_000
    us = lambda c: F.unix_micros(c)
    rows = candidates(x.star.conformed).select("reading_id", "machine_id", "alert_code", "event_time")
    bucket = F.floor(us("event_time") / span)
    # Only the first and last time in a bucket can decide whether an earlier one is in range.
    earlier = rows.groupBy("machine_id", "alert_code", bucket.alias("b")).agg(
        F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    probe = rows.withColumn("b", F.explode(F.array(bucket, bucket - 1)))
    met = probe.join(earlier, ["machine_id", "alert_code", "b"])
    own = (F.col("lo") < F.col("event_time")) & (F.col("b") == bucket)
    before = (F.col("b") < bucket) & (us("hi") > us("event_time") - span)
    hit = met.where(own | before).select("reading_id", "alert_code").distinct()
    return rows.join(hit, ["reading_id", "alert_code"], "left_anti").select("reading_id", "alert_code")


@query("jn10", """SELECT machine_id, count(*) AS readings FROM readings r
WHERE NOT EXISTS (SELECT 1 FROM dim_machine d WHERE d.machine_id = r.machine_id) GROUP BY ALL""")
def not_exists(x: Context):
    per = x.readings.groupBy("machine_id").agg(F.count("*").alias("readings"))
    return per.join(x.star.machines.select("machine_id"), "machine_id", "left_anti")


@query("jn11", """SELECT reading_id, machine_key FROM sensor WHERE machine_key IN (SELECT machine_key FROM dim_machine WHERE production_line = 'LINE-A')""")
def in_subquery(x: Context):
    line = x.star.machines.where("production_line = 'LINE-A'").select("machine_key")
    return x.star.sensor.join(line, "machine_key", "left_semi").select("reading_id", "machine_key")


@query("jn12", """SELECT machine_key, count(*) AS readings FROM sensor WHERE machine_key IN
(SELECT machine_key FROM dim_machine WHERE production_line = 'LINE-B') OR machine_key = -1 GROUP BY ALL""")
def membership_or_constant(x: Context):
    line = x.star.machines.where("production_line = 'LINE-B'").select("machine_key", F.lit(True).alias("seen"))
    return lookup(x.star.sensor, line, "machine_key").where(F.col("seen") | (F.col("machine_key") == -1)).groupBy(
        "machine_key").agg(F.count("*").alias("readings"))


@query("jn13", """SELECT u.user_principal_name, m.machine_id, count(h.window_start) AS hours
FROM user_scope u JOIN dim_machine m ON u.is_active AND (u.plant_code IS NULL OR u.plant_code = m.plant_code)
  AND (u.production_line IS NULL OR u.production_line = m.production_line)
JOIN hourly h ON h.machine_key = m.machine_key GROUP BY ALL""")
def wildcard_theta(x: Context):
    hours = x.star.hourly.groupBy("machine_key").agg(F.count("*").alias("n"))
    scopes = seeds.user_scopes(x.spark).where("is_active")
    mine = wildcard_members(x.star.machines, scopes, ("plant_code", "production_line"), "user_principal_name", ("machine_key", "machine_id"))
    return mine.join(hours, "machine_key").select("user_principal_name", "machine_id", F.col("n").alias("hours"))


@query("jn14", """SELECT v.machine_id, v.machine_name AS current_name, m.machine_name AS source_name, count(r.reading_id) AS readings
FROM versions v JOIN master m ON m.machine_id = v.machine_id JOIN readings r ON r.machine_id = v.machine_id
WHERE v.is_current AND v.machine_name IS DISTINCT FROM m.machine_name GROUP BY ALL""")
def inequality_join(x: Context):
    from ..operators.scd2 import drift

    out = drift(versions(x), x.star.master, ("machine_name",))
    per = x.readings.groupBy("machine_id").agg(F.count("*").alias("readings"))
    return out.join(per, "machine_id").select("machine_id", F.col("current_machine_name").alias("current_name"),
                                              F.col("source_machine_name").alias("source_name"), "readings")


def stale_copy(x: Context):
    """A copy of the hourly fact taken before the last day's readings arrived."""
    early = x.star.conformed.crossJoin(F.broadcast(x.newest())).where(
        F.col("event_time") <= F.col("as_of") - F.expr("INTERVAL 90 MINUTES")).drop("as_of")
    return production.hourly_fact(early)


STALE_SQL = """stale AS (SELECT machine_key, date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, CAST(sum(units_produced) AS BIGINT) AS units_produced,
  CAST(sum(good_units) AS BIGINT) AS good_units, 5 * sum(power_kw) AS kw_seconds
FROM conformed, newest WHERE event_time <= as_of - INTERVAL 90 MINUTE GROUP BY ALL)"""


@query("jn15", f"""WITH {STALE_SQL} SELECT h.machine_key, h.window_start, h.units_produced AS star_units, s.units_produced AS copy_units
FROM hourly h JOIN stale s USING (machine_key, window_start) WHERE h.units_produced IS DISTINCT FROM s.units_produced""")
def value_drift(x: Context):
    out = snowflake.stale_values(x.star.hourly, stale_copy(x), snowflake.HOURLY_KEYS, "units_produced")
    return out.select("machine_key", "window_start", F.col("units_produced").alias("star_units"),
                      F.col("_copy").alias("copy_units"))


@query("jn16", """SELECT (SELECT count(*) FROM readings) AS readings, (SELECT count(*) FROM hourly) AS hours""")
def one_row_cross(x: Context):
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(x.readings, "readings").crossJoin(n(x.star.hourly, "hours"))


@query("jn17", """SELECT m.machine_id, d.full_date, CAST(h.range AS INTEGER) AS hour_24, count(r.reading_id) AS readings
FROM master m CROSS JOIN days d CROSS JOIN range(24) h
LEFT JOIN readings r ON CAST(r.event_time AS DATE) = d.full_date AND hour(r.event_time) = h.range AND r.machine_id = m.machine_id
GROUP BY ALL HAVING count(r.reading_id) = 0""")
def silent_hours(x: Context):
    return quality.silent_hours(x.readings, "event_time", x.star.master, "machine_id")


@query("jn18", """SELECT r.machine_id, count(*) AS after_open FROM readings r JOIN (SELECT machine_id, max(started_at) AS s FROM stops
WHERE ended_at IS NULL GROUP BY ALL) o ON o.machine_id = r.machine_id AND r.event_time >= o.s GROUP BY ALL""")
def carry_open(x: Context):
    openers = newest_per(x.star.downtime.where("ended_at IS NULL").select("machine_id", "started_at"),
                         ["machine_id"], ["started_at"])
    rows = lookup(x.readings, openers, "machine_id").where(F.col("event_time") >= F.col("started_at"))
    return rows.groupBy("machine_id").agg(F.count("*").alias("after_open"))


@query("jn19", """SELECT f.alert_id, a.alert_type_key FROM failure_alerts f LEFT JOIN dim_alert_type a ON a.alert_code = f.alert_type""")
def renamed_key(x: Context):
    dim = x.star.alert_types.select("alert_type_key", F.col("alert_code").alias("alert_type"))
    return lookup(x.star.failure_alerts, dim, "alert_type").select("alert_id", "alert_type_key")


@query("jn20", """SELECT a.machine_id, a.readings, coalesce(b.alerts, 0) AS alerts FROM (SELECT machine_id, count(*) AS readings FROM readings GROUP BY ALL) a
LEFT JOIN (SELECT machine_id, count(*) AS alerts FROM failure_alerts WHERE severity = 'CRITICAL' GROUP BY ALL) b ON b.machine_id = a.machine_id""")
def join_of_aggregates(x: Context):
    a = x.readings.groupBy("machine_id").agg(F.count("*").alias("readings"))
    b = x.star.failure_alerts.where("severity = 'CRITICAL'").groupBy("machine_id").agg(F.count("*").alias("n"))
    return a.join(b, "machine_id", "left").select("machine_id", "readings", F.coalesce("n", F.lit(0)).alias("alerts"))


@query("jn21", """SELECT r.reading_id, v.machine_key, v.production_line FROM readings r LEFT JOIN versions v
ON v.machine_id = r.machine_id AND r.event_time >= v.valid_from AND r.event_time < v.valid_to""")
def as_of_join(x: Context):
    dim = versions(x).select("machine_id", "machine_key", "production_line", "valid_from", "valid_to")
    return as_of_version(x.readings, dim, "machine_id", "event_time").select(
        "reading_id", "machine_key", "production_line")


@query("jn22", """SELECT reading_id, raised_at, time_to_acknowledge_min, time_to_resolve_min, breached_sla FROM alerts""")
def join_update(x: Context):
    return x.star.alerts.select("reading_id", "raised_at", "time_to_acknowledge_min", "time_to_resolve_min", "breached_sla")


@query("jn23", """SELECT m.machine_name, s.shift_name, sum(h.units_produced)::BIGINT AS units FROM hourly h
LEFT JOIN dim_machine m ON m.machine_key = h.machine_key LEFT JOIN dim_shift s ON s.shift_key = h.shift_key GROUP BY ALL""")
def relationships(x: Context):
    wide = denormalise(x.star.hourly, {"machine_key": x.star.machines.select("machine_key", "machine_name"),
                                       "shift_key": x.star.shifts.select("shift_key", "shift_name")})
    return wide.groupBy("machine_name", "shift_name").agg(F.sum("units_produced").cast("bigint").alias("units"))


@query("jn24", """SELECT alert_id, coalesce(a.alert_type_key, (SELECT alert_type_key FROM dim_alert_type WHERE alert_code = 'FAULT_STATUS')) AS alert_type_key
FROM (SELECT alert_id, CASE WHEN alert_id % 10 = 0 THEN 'STRANGE' ELSE alert_type END AS code FROM failure_alerts) f
LEFT JOIN dim_alert_type a ON a.alert_code = f.code""")
def scalar_default(x: Context):
    odd = x.star.failure_alerts.withColumn(
        "code", F.when(F.col("alert_id") % 10 == 0, "STRANGE").otherwise(F.col("alert_type")))
    dim = x.star.alert_types.select("alert_type_key", F.col("alert_code").alias("code"))
    default = dim.where("code = 'FAULT_STATUS'").select(F.col("alert_type_key").alias("d"))
    return lookup(odd, dim, "code").crossJoin(F.broadcast(default)).select(
        "alert_id", F.coalesce("alert_type_key", "d").alias("alert_type_key"))


