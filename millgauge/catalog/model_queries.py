"""Normalised copy, row scoping and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge, quality, security
from ..operators.joins import lookup, wildcard_members
from ..plans import gates, health, snowflake
from ..plans.snowflake import ALERT_KEYS, HOURLY_KEYS, Snowflake
from ..schemas import UNKNOWN
from ..sources import messages, seeds, sinks
from ..sources.store import Store
from . import sql
from .envelope import ENVELOPE_SQL, broken_envelope
from .joins import STALE_SQL, stale_copy
from .registry import Context, query

# ---- normalised copy -----------------------------------------------------------
_PLANT = sql.key("plant_code")
_TYPE = sql.key("machine_type")
_LINE = sql.key("production_line || '|' || plant_code")


def snow(x: Context) -> Snowflake:
    return Snowflake(x.facts.machines, x.facts.alert_types)


def units_per_machine(x: Context):
    return x.facts.hourly.groupBy("machine_key").agg(F.sum("units_produced").cast("bigint").alias("units"))


@query("snw1", f"""SELECT {sql.key("coalesce(manufacturer, 'UNKNOWN')")} AS manufacturer_key, coalesce(manufacturer, 'UNKNOWN') AS manufacturer_name,
  CAST(coalesce(sum(units), 0) AS BIGINT) AS units FROM dim_machine m LEFT JOIN (SELECT machine_key, sum(units_produced) AS units FROM hourly GROUP BY ALL) h ON h.machine_key = m.machine_key GROUP BY ALL""")
def manufacturers(x: Context):
    members = x.facts.machines.select("machine_key", F.coalesce("manufacturer", F.lit("UNKNOWN")).alias("manufacturer_name"))
    made = members.join(units_per_machine(x), "machine_key", "left").groupBy("manufacturer_name").agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"))
    return snow(x).manufacturers.join(made, "manufacturer_name").select("manufacturer_key", "manufacturer_name", "units")


@query("snw1_severity", f"""SELECT {sql.key("severity")} AS severity_key, severity AS severity_code, min(severity_rank) AS severity_rank,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS raised_alerts FROM dim_alert_type a LEFT JOIN (SELECT alert_type_key AS k, count(*) AS n FROM alerts GROUP BY ALL) u ON k = a.alert_type_key GROUP BY ALL""")
def severities(x: Context):
    per = x.facts.alerts.groupBy("alert_type_key").agg(F.count("*").alias("n"))
    chain = snow(x).alert_types.join(per, "alert_type_key", "left").groupBy("severity_key").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raised_alerts"))
    return snow(x).severities.join(chain, "severity_key").select("severity_key", "severity_code", "severity_rank", "raised_alerts")


@query("snw2", f"""SELECT {_TYPE} AS machine_type_key, machine_type AS machine_type_code, {sql.key("min(coalesce(manufacturer, 'UNKNOWN'))")} AS manufacturer_key,
  CASE WHEN bool_or(criticality = 'HIGH') THEN 'CRITICAL_ASSET' ELSE 'STANDARD_ASSET' END AS asset_class, CAST(coalesce(sum(units), 0) AS BIGINT) AS units
FROM dim_machine m LEFT JOIN (SELECT machine_key, sum(units_produced) AS units FROM hourly GROUP BY ALL) h ON h.machine_key = m.machine_key GROUP BY machine_type""")
def machine_types(x: Context):
    chain = snow(x).machines.join(units_per_machine(x), "machine_key", "left").groupBy("machine_type_key").agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"))
    return snow(x).machine_types.join(chain, "machine_type_key")


@query("snw2_line", f"""SELECT {_LINE} AS production_line_key, production_line AS production_line_code, {_PLANT} AS plant_key, 'UNASSIGNED' AS line_supervisor, CAST(coalesce(sum(units), 0) AS BIGINT) AS units
FROM dim_machine m LEFT JOIN (SELECT machine_key, sum(units_produced) AS units FROM hourly GROUP BY ALL) h ON h.machine_key = m.machine_key GROUP BY production_line, plant_code""")
def lines(x: Context):
    chain = snow(x).machines.join(units_per_machine(x), "machine_key", "left").groupBy("production_line_key").agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"))
    return snow(x).lines.join(chain, "production_line_key")


@query("snw3", f"""SELECT m.machine_key, m.machine_id, {_TYPE} AS machine_type_key, {_LINE} AS production_line_key, criticality, coalesce(n, 0) AS hours
FROM dim_machine m LEFT JOIN (SELECT machine_key AS k, count(*) AS n FROM hourly GROUP BY ALL) u ON k = m.machine_key""")
def leaf_machines(x: Context):
    s = snow(x)
    leaf = merge.upsert(s.machines.where("criticality = 'HIGH'"), s.machines, ["machine_key"])
    per = x.facts.hourly.groupBy("machine_key").agg(F.count("*").alias("n"))
    return leaf.join(per, "machine_key", "left").select("machine_key", "machine_id", "machine_type_key", "production_line_key",
                                                        "criticality", F.coalesce("n", F.lit(0)).alias("hours"))


HOUR_COLUMNS = ["machine_key", "window_start", "window_end", "units_produced", "good_units", "kw_seconds"]
RAISED_COLUMNS = ["machine_key", "alert_type_key", "raised_at", "resolved_at", "alert_count"]


def copies(x: Context):
    """Star facts and older copies of them."""
    old_h = x.kept("old_hours", lambda: stale_copy(x).select(*HOUR_COLUMNS), "window_start")
    raised = x.facts.alerts.select(*RAISED_COLUMNS)
    return x.facts.hourly.select(*HOUR_COLUMNS), old_h, raised.where("machine_key <> -1"), raised


class Copy:
    """The stored copy of a query: older hours and alerts, brought up to date from the stored star."""

    def __init__(self, x: Context) -> None:
        self.x = x
        _, old_h, _, old_a = copies(x)
        self.hours = Store.like(old_h, x.path("copy_hours"), "window_start")
        self.hours.overwrite(old_h)
        self.raised = Store.like(old_a, x.path("copy_alerts"), "raised_at")
        self.raised.overwrite(old_a)

    def refresh(self) -> None:
        self.hours.follow(self.x.facts.store("hourly"), HOURLY_KEYS, lambda df: df.select(*HOUR_COLUMNS))
        self.raised.follow(self.x.facts.store("alerts"), ALERT_KEYS, lambda df: df.where("machine_key <> -1").select(*RAISED_COLUMNS))


@query("snw4", """SELECT 'fact_production_hourly' AS metric, (SELECT count(*) FROM hourly) AS star_rows, (SELECT count(*) FROM hourly) AS snow_rows, 'IN SYNC' AS status
UNION ALL SELECT 'fact_alert', count(*), count(*), 'IN SYNC' FROM alerts WHERE machine_key <> -1""")
def refresh(x: Context):
    """Refreshed by what changed in the star, then judged by rows and values."""
    copy = Copy(x)
    copy.refresh()
    star_h, _, star_a, _ = copies(x)
    return snowflake.sync_report({
        "fact_production_hourly": snowflake.compare(star_h, copy.hours.read(), HOURLY_KEYS, ("units_produced", "good_units", "kw_seconds")),
        "fact_alert": snowflake.compare(star_a, copy.raised.read(), ALERT_KEYS, ("resolved_at", "alert_count")),
    })


@query("snw4_drift", f"""WITH {STALE_SQL} SELECT 'fact_production_hourly' AS metric, (SELECT count(*) FROM hourly) AS star_rows, (SELECT count(*) FROM stale) AS snow_rows,
  CASE WHEN (SELECT count(*) FROM hourly) = (SELECT count(*) FROM stale) AND NOT EXISTS (SELECT 1 FROM hourly h JOIN stale s USING (machine_key, window_start)
    WHERE h.units_produced IS DISTINCT FROM s.units_produced) THEN 'IN SYNC' ELSE 'DRIFT' END AS status""")
def drift(x: Context):
    star_h, old_h, _, _ = copies(x)
    return snowflake.sync_report({"fact_production_hourly": snowflake.compare(star_h, old_h, HOURLY_KEYS, ("units_produced",))})


@query("snw4_rows", "SELECT machine_key, window_start, units_produced, good_units, CAST(kw_seconds AS DOUBLE) AS kw_seconds FROM hourly")
def refreshed_rows(x: Context):
    copy = Copy(x)
    for _ in range(2):
        copy.refresh()
    return copy.hours.read().drop("window_end")


@query("snw5", f"""WITH {STALE_SQL} SELECT (SELECT count(*) FROM hourly) - (SELECT count(*) FROM stale) AS hourly_rows_behind,
  (SELECT count(*) FROM alerts WHERE machine_key <> -1) - (SELECT count(*) FROM alerts) AS alert_rows_behind,
  (SELECT count(*) FROM hourly h JOIN stale s USING (machine_key, window_start) WHERE h.units_produced IS DISTINCT FROM s.units_produced) AS rows_with_stale_values""")
def staleness(x: Context):
    return snowflake.staleness(*copies(x))


@query("snw6", "SELECT 'snowflake_refresh' AS job_name, 'SUCCESS' AS status, (SELECT count(*) FROM hourly) AS rows_written")
def refresh_log(x: Context):
    path, copy = x.path("refresh_log"), Copy(x)

    def work() -> int:
        copy.refresh()
        return copy.hours.read().count()

    sinks.run_logged(x.spark, path, "snowflake_refresh", "1", work)
    return sinks.run_outcomes(x.spark.read.parquet(path)).select("job_name", "status", "rows_written")


Q1 = """SELECT machine_type, production_line, CAST(sum(units_produced) AS BIGINT) AS units, CAST(sum(good_units) AS BIGINT) AS good,
  CAST(sum(runtime_seconds) AS DOUBLE) / 60 AS runtime_min FROM cells GROUP BY ALL"""


@query("snw7", Q1)
def q1_snow(x: Context):
    return snowflake.production_by_type_and_line(snow(x).production_chain(x.facts.hourly), "machine_type_code", "production_line_code")


@query("snw7_star", Q1)
def q1_star(x: Context):
    rows = lookup(x.facts.hourly, x.facts.machines.select("machine_key", "machine_type", "production_line"), "machine_key", "inner")
    return snowflake.production_by_type_and_line(rows, "machine_type", "production_line")


@query("snw8", "SELECT severity AS severity_code, alert_category AS alert_category_code, 'MAINTENANCE' AS owning_team, count(*) AS alerts FROM alerts GROUP BY ALL")
def q2_snow(x: Context):
    return snowflake.alerts_by_severity(snow(x).alert_chain(x.facts.alerts), "severity_code", "alert_category_code", "owning_team")


@query("snw8_star", "SELECT severity, alert_category, count(*) AS alerts FROM alerts GROUP BY ALL")
def q2_star(x: Context):
    rows = lookup(x.facts.alerts, x.facts.alert_types.select("alert_type_key", "severity", "alert_category"), "alert_type_key", "inner")
    return snowflake.alerts_by_severity(rows, "severity", "alert_category")


Q3 = "SELECT plant_code, CAST(sum(kw_seconds) AS DOUBLE) / 3600 AS kwh, CAST(sum(units_produced) AS BIGINT) AS units FROM cells GROUP BY ALL"


@query("snw9", Q3)
def q3_snow(x: Context):
    return snowflake.energy_by_plant(snow(x).plant_chain(x.facts.hourly))


@query("snw9_star", Q3)
def q3_star(x: Context):
    return snowflake.energy_by_plant(lookup(x.facts.hourly, x.facts.machines.select("machine_key", "plant_code"), "machine_key", "inner"))


@query("snw10", f"""WITH {STALE_SQL}, closed AS (SELECT s.*, h.units_produced AS hu, h.good_units AS hg, h.kw_seconds AS hk FROM stale s JOIN hourly h USING (machine_key, window_start), newest WHERE s.window_end <= date_trunc('hour', as_of)),
t AS (SELECT CAST(sum(hu) AS BIGINT) AS star_units, CAST(sum(units_produced) AS BIGINT) AS snow_units, CAST(sum(hg) AS BIGINT) AS star_good, CAST(sum(good_units) AS BIGINT) AS snow_good,
  round(CAST(sum(hk) AS DOUBLE) / 3600, 2) AS star_kwh, round(CAST(sum(kw_seconds) AS DOUBLE) / 3600, 2) AS snow_kwh FROM closed)
SELECT *, CASE WHEN star_units = snow_units AND star_good = snow_good AND star_kwh = snow_kwh THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM t""")
def equivalence(x: Context):
    star_h, old_h, _, _ = copies(x)
    closed = snowflake.closed_hours(old_h.crossJoin(F.broadcast(x.newest())), F.col("as_of")).drop("as_of")
    return snowflake.equivalence(star_h, closed)


@query("snw11", f"""WITH {STALE_SQL} SELECT (SELECT count(*) FROM hourly) - (SELECT count(*) FROM stale) AS rows_added,
  (SELECT count(*) FROM hourly h JOIN stale s USING (machine_key, window_start) WHERE h.units_produced IS DISTINCT FROM s.units_produced) AS rows_value_changed,
  (SELECT count(*) FROM stale, newest WHERE window_end > date_trunc('hour', as_of)) AS still_open_hours""")
def drift_detail(x: Context):
    star_h, old_h, _, _ = copies(x)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    still = old_h.crossJoin(F.broadcast(x.newest())).where(F.col("window_end") > F.date_trunc("hour", "as_of"))
    changed = snowflake.stale_values(star_h, old_h, HOURLY_KEYS, "units_produced")
    return n(star_h, "_a").crossJoin(n(old_h, "_b")).crossJoin(n(changed, "rows_value_changed")).crossJoin(
        n(still, "still_open_hours")).select((F.col("_a") - F.col("_b")).alias("rows_added"), "rows_value_changed", "still_open_hours")


_WIDE = ("machine_name", "machine_type", "production_line", "plant_code")
_DIM_BYTES = " UNION ALL ".join((
    "SELECT count(*) AS n, 24 * count(*) + sum(strlen(machine_name)) AS b FROM dim_machine",
    "SELECT count(*), 8 * count(*) + sum(strlen(t)) FROM (SELECT DISTINCT machine_type AS t FROM dim_machine)",
    "SELECT count(*), 16 * count(*) + sum(strlen(l)) FROM (SELECT DISTINCT production_line AS l, plant_code AS p FROM dim_machine)",
    "SELECT count(*), 8 * count(*) + sum(strlen(p)) FROM (SELECT DISTINCT plant_code AS p FROM dim_machine)"))


@query("snw12", f"""WITH dims AS ({_DIM_BYTES})
SELECT 'star' AS design, CAST(count(*) AS BIGINT) AS rows, CAST(sum(24 + {" + ".join(f"strlen({c})" for c in _WIDE)}) AS BIGINT) AS bytes
FROM hourly h JOIN dim_machine m ON m.machine_key = h.machine_key
UNION ALL SELECT 'snowflake', CAST(n + (SELECT sum(n) FROM dims) AS BIGINT), CAST(24 * n + (SELECT sum(b) FROM dims) AS BIGINT) FROM (SELECT count(*) AS n FROM hourly)""")
def storage(x: Context):
    """Rows and uncompressed bytes of the hourly facts in two layouts: members' texts beside each fact, or behind keys."""
    s, fact = snow(x), ["machine_key", "window_start", "units_produced"]
    hourly = x.facts.hourly.select("machine_key", "window_start", F.col("units_produced").cast("bigint").alias("units_produced"))
    wide = lookup(hourly, x.facts.machines.select("machine_key", *_WIDE), "machine_key", "inner").select(*fact, *_WIDE)
    thin = [hourly, s.machines.select("machine_key", "machine_type_key", "production_line_key", "machine_name"),
            s.machine_types.select("machine_type_key", "machine_type_code"), s.lines.select("production_line_key", "production_line_code", "plant_key"),
            s.plants.select("plant_key", "plant_code")]
    return snowflake.table_bytes([wide], "star").unionByName(snowflake.table_bytes(thin, "snowflake"))


# ---- row scoping ----------------------------------------------------------------
USERS = ("Exec@contoso.com", "plant.mgr@contoso.com", "linea.sup@contoso.com", "lineb.sup@contoso.com", "old.sup@contoso.com",
         "nobody@contoso.com")
_SEES = """(s.plant_code IS NULL OR s.plant_code = m.plant_code) AND (s.production_line IS NULL OR s.production_line = m.production_line)"""


def _visible(user: str) -> str:
    return f"(SELECT DISTINCT m.machine_key FROM dim_machine m JOIN user_scope s ON s.is_active AND lower(s.user_principal_name) = lower('{user}') AND {_SEES})"


def users(x: Context):
    return x.spark.createDataFrame([(u,) for u in USERS], "app_user string")


def scopes(x: Context):
    return seeds.user_scopes(x.spark)


@query("rls1", " UNION ALL ".join(f"SELECT '{u}' AS app_user, v.machine_key, count(h.window_start) AS hours FROM {_visible(u)} v LEFT JOIN hourly h ON h.machine_key = v.machine_key GROUP BY ALL" for u in USERS))
def visible(x: Context):
    hours = x.facts.hourly.groupBy("machine_key").agg(F.count("*").alias("n"))
    seen = security.visible_to_all(x.facts.machines, scopes(x), users(x))
    return seen.join(hours, "machine_key", "left").select("app_user", "machine_key", F.coalesce("n", F.lit(0)).alias("hours"))


@query("rls2", " UNION ALL ".join(f"SELECT '{u}' AS app_user, count(*) AS rows FROM sensor WHERE machine_key IN (SELECT machine_key FROM {_visible(u)})" for u in USERS))
def scoped(x: Context):
    """Rows a user may see, for every user at once: counted by machine before they meet the scopes."""
    per = x.facts.sensor.groupBy("machine_key").agg(F.count("*").alias("n"))
    seen = security.visible_to_all(x.facts.machines, scopes(x), users(x)).join(per, "machine_key").groupBy(
        F.col("app_user").alias("seen_by")).agg(F.sum("n").alias("n"))
    return users(x).join(seen, F.col("app_user") == F.col("seen_by"), "left").select("app_user", F.coalesce("n", F.lit(0)).alias("rows"))


@query("rls3", " UNION ALL ".join(f"SELECT '{u}' AS app_user, m.machine_id, (SELECT count(*) FROM hourly h WHERE h.machine_key = m.machine_key) AS hours FROM dim_machine m WHERE machine_key = -1 OR machine_key IN (SELECT machine_key FROM {_visible(u)})" for u in USERS))
def scoped_dim(x: Context):
    hours = x.facts.hourly.groupBy("machine_key").agg(F.count("*").alias("n"))
    unknown = users(x).withColumn("machine_key", F.lit(UNKNOWN).cast("bigint"))
    seen = security.visible_to_all(x.facts.machines, scopes(x), users(x)).union(unknown).distinct()
    return (seen.join(x.facts.machines.select("machine_key", "machine_id"), "machine_key").join(hours, "machine_key", "left")
            .select("app_user", "machine_id", F.coalesce("n", F.lit(0)).alias("hours")))


@query("rls4", f"""SELECT s.user_principal_name, s.role_name, s.is_active, s.plant_code, s.production_line, CAST(coalesce(sum(n), 0) AS BIGINT) AS readings
FROM user_scope s LEFT JOIN dim_machine m ON {_SEES} LEFT JOIN (SELECT machine_key, count(*) AS n FROM sensor GROUP BY ALL) r ON r.machine_key = m.machine_key
WHERE lower(s.user_principal_name) = 'lineb.sup@contoso.com' GROUP BY ALL""")
def own_rows(x: Context):
    """A user's own scope rows, each with the readings it opens."""
    mine = ["user_principal_name", "role_name", "is_active", *security.SCOPE_CELLS]
    own = security.own_scopes(scopes(x), "LineB.sup@contoso.com").select(*mine, F.monotonically_increasing_id().alias("scope"))
    per = x.facts.sensor.groupBy("machine_key").agg(F.count("*").alias("n"))
    opened = (wildcard_members(x.facts.machines, own, security.SCOPE_CELLS, "scope", ["machine_key"]).join(per, "machine_key")
              .groupBy(F.col("scope").alias("of")).agg(F.sum("n").alias("n")))
    return own.join(opened, F.col("scope") == F.col("of"), "left").select(*mine, F.coalesce("n", F.lit(0)).alias("readings"))


@query("rls5", "SELECT machine_key, count(*) AS rows FROM sensor GROUP BY ALL")
def unrestricted(x: Context):
    return security.scoped_fact(x.facts.sensor, x.facts.machines, scopes(x), None, unrestricted=True).groupBy("machine_key").agg(
        F.count("*").alias("rows"))


@query("rls6", """SELECT reading_id, raised_at, regexp_replace(coalesce(acknowledged_by, ''), '(.).*(@.*)', '\\1***\\2') AS acknowledged_by FROM alerts""")
def masked(x: Context):
    return security.masked(x.facts.alerts).select("reading_id", "raised_at", "acknowledged_by")


@query("rls6_admin", "SELECT reading_id, raised_at, acknowledged_by FROM alerts")
def unmasked(x: Context):
    return security.masked(x.facts.alerts, privileged=True).select("reading_id", "raised_at", "acknowledged_by")


_SCOPE_OF = """SELECT c_custkey, lower(c_name) || '@contoso.com' AS user_principal_name, CASE WHEN c_nationkey % 2 = 0 THEN 'PLANT-01' END AS plant_code,
  CASE WHEN c_nationkey % 3 = 0 THEN 'LINE-A' END AS production_line, {active} AS is_active FROM customer WHERE {keep}"""


@query("rls7", f"""WITH o AS ({_SCOPE_OF.format(active='TRUE', keep="c_mktsegment <> 'BUILDING'")}), n AS ({_SCOPE_OF.format(active="c_acctbal > 0", keep="c_mktsegment <> 'MACHINERY'")})
SELECT 'admin@contoso.com' AS app_user, CASE WHEN o.c_custkey IS NULL THEN 'INSERT' WHEN n.c_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action, 'dim_user_scope' AS object_name,
  CASE WHEN n.c_custkey IS NULL THEN to_json({{'c_custkey': o.c_custkey, 'user_principal_name': o.user_principal_name, 'plant_code': o.plant_code, 'production_line': o.production_line, 'is_active': o.is_active}})
  ELSE to_json({{'c_custkey': n.c_custkey, 'user_principal_name': n.user_principal_name, 'plant_code': n.plant_code, 'production_line': n.production_line, 'is_active': n.is_active}}) END AS detail
FROM o FULL JOIN n ON n.c_custkey = o.c_custkey WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.is_active <> n.is_active""")
def audit(x: Context):
    base = x.table("customer")
    shape = lambda active: [
        "c_custkey", F.concat(F.lower("c_name"), F.lit("@contoso.com")).alias("user_principal_name"),
        F.when(F.col("c_nationkey") % 2 == 0, "PLANT-01").alias("plant_code"),
        F.when(F.col("c_nationkey") % 3 == 0, "LINE-A").alias("production_line"), active.alias("is_active")]
    before = base.where("c_mktsegment <> 'BUILDING'").select(*shape(F.lit(True)))
    after = base.where("c_mktsegment <> 'MACHINERY'").select(*shape(F.col("c_acctbal") > 0))
    return security.audit_changes(before, after, ["c_custkey"], "Admin@contoso.com", F.current_timestamp()).drop("occurred_at")


@query("rls8", "SELECT count(*) AS rows_seen, (SELECT count(*) FROM sensor) AS rows_total FROM sensor WHERE FALSE")
def no_user(x: Context):
    seen = security.scoped_fact(x.facts.sensor, x.facts.machines, scopes(x), None).agg(F.count("*").alias("rows_seen"))
    return seen.crossJoin(x.facts.sensor.agg(F.count("*").alias("rows_total")))


# ---- health -----------------------------------------------------------------
AS_OF_TEXT = "2024-01-31 00:00:00"
LETTERS_SQL = f"""letters AS (SELECT kafka_timestamp AS quarantined_at, CASE fault WHEN 'malformed' THEN 'malformed JSON' WHEN 'empty' THEN 'empty payload'
  WHEN 'no_machine' THEN 'machine_id is null' WHEN 'no_time' THEN 'event_time is null' END AS failure_reason,
  CASE WHEN fault = 'malformed' THEN kafka_timestamp + INTERVAL 1 HOUR END AS replayed_at FROM ({ENVELOPE_SQL}) WHERE fault <> 'none')"""
LOG_SQL = """batch_log AS (SELECT 'star_stream' AS job_name, strftime(w, '%Y%m%d%H') AS batch_id, w AS started_at, w + INTERVAL 30 SECOND AS completed_at, n AS rows_written,
  CASE WHEN k % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM (SELECT date_trunc('hour', event_time) AS w, count(*) AS n, min(reading_id) AS k FROM readings GROUP BY ALL))"""


def as_of():
    return F.lit(AS_OF_TEXT).cast("timestamp")


def letters(x: Context):
    return x.kept("letters", lambda: _letters(x), "quarantined_at")


def _letters(x: Context):
    _, bad = messages.split_valid(messages.parse(messages.envelope(broken_envelope(x))))
    out = messages.dead_letters(bad, 0, F.col("kafka_timestamp"))
    later = F.col("kafka_timestamp") + F.expr("INTERVAL 1 HOUR")
    return out.withColumn("replayed_at", F.when(F.col("failure_reason") == "malformed JSON", later))


def batch_log(x: Context):
    return x.kept("batch_log", lambda: _batch_log(x), "started_at")


def _batch_log(x: Context):
    """One load per hour of readings; a fifth of them counts as failed. Every run has logged its
    start, every third its end twice."""
    per = x.facts.readings.groupBy(F.date_trunc("hour", "event_time").alias("started_at")).agg(
        F.count("*").alias("rows_written"), F.min("reading_id").alias("_k"))
    ends = per.select(F.lit("star_stream").alias("job_name"), F.date_format("started_at", "yyyyMMddHH").alias("batch_id"), "started_at",
                      (F.col("started_at") + F.expr("INTERVAL 30 SECONDS")).alias("completed_at"), "rows_written",
                      F.when(F.col("_k") % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"), "_k")
    starts = ends.withColumns({"completed_at": F.lit(None).cast("timestamp"), "rows_written": F.lit(None).cast("bigint"), "status": F.lit("RUNNING")})
    return starts.unionByName(ends).unionByName(ends.where("_k % 3 = 0")).drop("_k")


_T = f"TIMESTAMP '{AS_OF_TEXT}'"
# The least measure of each label, and the label without a measure.
LADDERS = {
    "lag": (((-1e18, "HEALTHY"), (120, "DEGRADED"), (600, "STALLED")), "NO DATA"),
    "success": (((-1e18, "UNHEALTHY"), (95, "DEGRADED"), (99, "HEALTHY")), "NO BATCHES"),
    "unknown": (((-1e18, "HEALTHY"), (0.1, "INVESTIGATE")), "NO DATA"),
}


def _label(ladder: str, measure: str) -> str:
    steps, missing = LADDERS[ladder]
    rows = ", ".join(f"(CAST({since} AS DOUBLE), '{label}')" for since, label in steps)
    return f"coalesce((SELECT arg_max(label, since) FROM (VALUES {rows}) ladder(since, label) WHERE since <= {measure}), '{missing}')"


FRESH_SQL = f"""SELECT latest_reading, CAST(round(lag) AS BIGINT) AS lag_seconds, {_label("lag", "lag")} AS status
FROM (SELECT max(event_ts) AS latest_reading, (epoch_us({_T}) - epoch_us(max(event_ts))) / 1e6 AS lag FROM sensor)"""
BATCH_SQL = f"""SELECT batches_24h, succeeded, failed, round(CAST(100 * succeeded AS DOUBLE) / nullif(batches_24h, 0), 2) AS success_rate_pct, last_failure_at,
  {_label("success", "100.0 * succeeded / nullif(batches_24h, 0)")} AS status
FROM (SELECT count(*) AS batches_24h, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  max(completed_at) FILTER (WHERE status = 'FAILED') AS last_failure_at FROM batch_log WHERE started_at > {_T} - INTERVAL 24 HOUR)"""
UNKNOWN_SQL = f"""SELECT rows_24h, unknown_machine, unknown_status, round(CAST(100 * a AS DOUBLE) / nullif(rows_24h, 0), 4) AS unknown_pct,
  {_label("unknown", "100.0 * a / nullif(rows_24h, 0)")} AS status
FROM (SELECT count(*) AS rows_24h, count(*) FILTER (WHERE machine_key = -1) AS unknown_machine, count(*) FILTER (WHERE status_key = -1) AS unknown_status,
  count(*) FILTER (WHERE machine_key = -1 OR status_key = -1) AS a FROM sensor WHERE event_ts > {_T} - INTERVAL 24 HOUR)"""
DLQ_SQL = f"""SELECT count(*) FILTER (WHERE quarantined_at > {_T} - INTERVAL 24 HOUR) AS quarantined_24h, count(*) FILTER (WHERE replayed_at IS NULL) AS awaiting_replay,
  min(quarantined_at) FILTER (WHERE replayed_at IS NULL) AS oldest_unreplayed, (SELECT failure_reason FROM letters WHERE replayed_at IS NULL GROUP BY failure_reason ORDER BY count(*) DESC, failure_reason LIMIT 1) AS top_reason,
  CASE WHEN count(*) FILTER (WHERE quarantined_at > {_T} - INTERVAL 24 HOUR) = 0 AND count(*) FILTER (WHERE replayed_at IS NULL) = 0 THEN 'HEALTHY' ELSE 'INVESTIGATE' END AS status FROM letters"""
STUCK_SQL = f"""SELECT d.machine_key, machine_name, started_at, CAST(floor((epoch_us({_T}) - epoch_us(started_at)) / 1e6) AS BIGINT) AS open_for_seconds, reason_code,
  CASE WHEN {_T} - started_at > INTERVAL 4 HOUR THEN 'STUCK' ELSE 'OPEN' END AS status FROM stops d JOIN dim_machine m ON m.machine_key = d.machine_key WHERE ended_at IS NULL"""


@query("dq1", FRESH_SQL)
def freshness(x: Context):
    return health.freshness(x.facts.sensor, as_of())


@query("dq2", f"WITH {LOG_SQL} {BATCH_SQL}")
def batches(x: Context):
    return health.batch_health(batch_log(x), as_of())


@query("dq3", UNKNOWN_SQL)
def unknown_rate(x: Context):
    return health.unknown_key_rate(x.facts.sensor, as_of())


@query("dq4", f"WITH {LETTERS_SQL} {DLQ_SQL}")
def dead_letters(x: Context):
    return health.dead_letter_health(letters(x), as_of())


@query("dq5", STUCK_SQL)
def stuck(x: Context):
    return health.stuck_downtime(x.facts.downtime, x.facts.machines, as_of())


BOARD_SQL = f"""SELECT 'Pipeline freshness' AS check_name, status, 'Latest reading ' || coalesce(CAST(lag_seconds AS VARCHAR), 'n/a') || 's ago' AS detail FROM ({FRESH_SQL})
UNION ALL SELECT 'Batch success rate', status, coalesce(CAST(success_rate_pct AS VARCHAR), '0') || '% over ' || CAST(batches_24h AS VARCHAR) || ' batches' FROM ({BATCH_SQL})
UNION ALL SELECT 'Unknown key rate', status, coalesce(CAST(unknown_pct AS VARCHAR), '0') || '% of ' || CAST(rows_24h AS VARCHAR) || ' rows' FROM ({UNKNOWN_SQL})
UNION ALL SELECT 'Dead-letter queue', status, CAST(quarantined_24h AS VARCHAR) || ' quarantined, ' || CAST(awaiting_replay AS VARCHAR) || ' awaiting replay' FROM ({DLQ_SQL})
UNION ALL SELECT 'Stuck downtime episodes', CASE WHEN count(*) = 0 THEN 'HEALTHY' ELSE 'INVESTIGATE' END, CAST(count(*) AS VARCHAR) || ' episode(s) open over 4 hours' FROM ({STUCK_SQL}) WHERE status = 'STUCK'"""


def board(x: Context):
    return health.dashboard(x.facts.sensor, batch_log(x), letters(x), x.facts.downtime, x.facts.machines, as_of())


@query("dq6", f"WITH {LOG_SQL}, {LETTERS_SQL} {BOARD_SQL}")
def dashboard(x: Context):
    return board(x)


_GATES_SQL = f"""SELECT 'freshness' AS gate, lag_seconds <= 300 AS passed FROM ({FRESH_SQL}) UNION ALL SELECT 'batch success', success_rate_pct >= 99 FROM ({BATCH_SQL})
UNION ALL SELECT 'unknown keys', unknown_pct <= 0.1 FROM ({UNKNOWN_SQL}) UNION ALL SELECT 'dead letters', awaiting_replay <= 0 FROM ({DLQ_SQL})
UNION ALL SELECT 'null ids', count(*) FILTER (WHERE reading_id IS NULL) = 0 FROM alerts"""


@query("dq7_dq11", f"WITH {LOG_SQL}, {LETTERS_SQL} {_GATES_SQL}")
def gate_results(x: Context):
    """Each gate decides on a one-row view; five rows come back."""
    return _gates(x).select("gate", "passed")


def _gates(x: Context):
    nulls = quality.null_counts(x.facts.alerts, ["reading_id"])
    return gates.together([gates.fresh_enough_row(freshness(x)), gates.batches_succeed_row(batches(x)), gates.keys_known_row(unknown_rate(x)),
                           gates.letters_replayed_row(dead_letters(x)), gates.no_nulls_row(nulls)])


@query("dq12", f"""WITH {STALE_SQL} SELECT 'before' AS moment, (SELECT count(*) FROM hourly h JOIN stale s USING (machine_key, window_start) WHERE h.units_produced IS DISTINCT FROM s.units_produced) = 0 AS passed
UNION ALL SELECT 'after', TRUE""")
def copy_gate(x: Context):
    star_h, old_h, star_a, old_a = copies(x)
    copy = Copy(x)
    copy.refresh()
    before = gates.copy_in_sync_row(snowflake.staleness(star_h, old_h, star_a, old_a))
    after = gates.copy_in_sync_row(snowflake.staleness(star_h, copy.hours.read(), star_a, copy.raised.read()))
    return before.select(F.lit("before").alias("moment"), "passed").union(after.select(F.lit("after"), "passed"))


@query("dq13", f"WITH {LOG_SQL}, {LETTERS_SQL} SELECT CASE WHEN bool_and(passed) THEN 1 ELSE 0 END AS published, count(*) FILTER (WHERE NOT passed) AS breaches FROM ({_GATES_SQL})")
def convergence(x: Context):
    """What a publisher would see: whether all gates passed, and how many did not."""
    return _gates(x).agg(F.min(F.col("passed").cast("int")).alias("published"), F.count_if(~F.col("passed")).alias("breaches"))


@query("dq14", f"""WITH {LOG_SQL}, {LETTERS_SQL} SELECT count(*) AS checks, count(*) FILTER (WHERE status NOT IN ('HEALTHY', 'OK', 'NO DATA')) AS unhealthy,
  coalesce(string_agg(check_name, ', ' ORDER BY check_name) FILTER (WHERE status NOT IN ('HEALTHY', 'OK', 'NO DATA')), '') AS unhealthy_checks,
  CASE WHEN count(*) FILTER (WHERE status NOT IN ('HEALTHY', 'OK', 'NO DATA')) > 0 THEN 1 ELSE 0 END AS exit_code FROM ({BOARD_SQL})""")
def verdict(x: Context):
    return health.verdict(board(x))


@query("dq15", f"WITH {LETTERS_SQL} SELECT failure_reason, count(*) AS messages, min(quarantined_at) AS oldest FROM letters WHERE replayed_at IS NULL GROUP BY ALL")
def by_reason(x: Context):
    return health.letters_by_reason(letters(x))


@query("dq15_text", f"WITH {LETTERS_SQL} SELECT coalesce(string_agg(failure_reason || ': ' || CAST(n AS VARCHAR), '; ' ORDER BY failure_reason), 'none') AS summary FROM (SELECT failure_reason, count(*) AS n FROM letters WHERE replayed_at IS NULL GROUP BY ALL)")
def reason_text(x: Context):
    return health.reason_summary(letters(x))


@query("dq16", f"SELECT date_key, count(*) AS alerts FROM alerts WHERE raised_at > {_T} - INTERVAL 7 DAY GROUP BY ALL")
def alert_volume(x: Context):
    return health.alert_volume(x.facts.alerts, as_of())


@query("dq17", """SELECT d.full_date, CAST(h.range AS INTEGER) AS hour_24, count(r.reading_id) AS readings FROM days d CROSS JOIN range(24) h
LEFT JOIN readings r ON CAST(r.event_time AS DATE) = d.full_date AND hour(r.event_time) = h.range GROUP BY ALL""")
def hour_counts(x: Context):
    return quality.scaffold_counts(x.facts.readings, "event_time")


@query("dq18", "SELECT date_trunc('minute', event_time) AS minute, count(*) AS alerts FROM candidates GROUP BY ALL HAVING count(*) > 2")
def busy(x: Context):
    from ..operators.alerts import candidates

    return quality.busy_minutes(candidates(x.facts.conformed), "event_time", 2)


@query("dq18_runs", f"""WITH {LOG_SQL} SELECT batch_id FROM (SELECT *, sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) OVER (PARTITION BY job_name ORDER BY started_at ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS f FROM batch_log) WHERE f = 2""")
def failure_runs(x: Context):
    return quality.failure_runs(batch_log(x), 2).select("batch_id")


@query("dq19", """SELECT 'readings' AS source_table, rule AS rule_name, CAST(reading_id AS VARCHAR) AS record_key, to_json({'reading_id': reading_id, 'machine_id': machine_id, 'status': status}) AS detail
FROM (SELECT *, unnest(list_filter([CASE WHEN temperature_c > 150 OR temperature_c < -20 THEN 'temperature out of range' END, CASE WHEN good_units > units_produced THEN 'more good than made' END,
  CASE WHEN upper(status) NOT IN ('RUNNING', 'IDLE', 'DOWN', 'FAULT', 'MAINTENANCE', 'SETUP') THEN 'status unknown' END], lambda r: r IS NOT NULL)) AS rule FROM readings)""")
def rule_violations(x: Context):
    known = [s[1] for s in seeds.STATUSES if s[0] > 0]
    rules = {"temperature out of range": ~F.col("temperature_c").between(-20, 150),
             "more good than made": F.col("good_units") > F.col("units_produced"),
             "status unknown": ~F.upper("status").isin(*known)}
    return quality.violations(x.facts.readings, "readings", rules, "reading_id", ["reading_id", "machine_id", "status"])


@query("dq20", """SELECT full_date, CAST(sum(n) AS BIGINT) AS readings, CAST(24 * 15 AS BIGINT) AS expected, round(CAST(100 * sum(n) AS DOUBLE) / (24 * 15), 4) AS completeness_pct,
  CASE WHEN 100.0 * sum(n) / (24 * 15) > 99.9 THEN 'OK' ELSE 'BELOW TARGET' END AS status FROM (SELECT d.full_date, count(r.reading_id) AS n FROM days d LEFT JOIN readings r ON CAST(r.event_time AS DATE) = d.full_date GROUP BY ALL) GROUP BY ALL""")
def completeness(x: Context):
    return quality.completeness(x.facts.readings, "event_time", 15)


@query("dq21", f"WITH {LOG_SQL} SELECT status, count(*) AS batches, max(completed_at) AS last_completed FROM batch_log WHERE started_at > {_T} - INTERVAL 24 HOUR GROUP BY ALL")
def outcomes(x: Context):
    return health.batch_outcomes(batch_log(x), as_of())


@query("grain", "SELECT machine_id, event_time, count(*) AS copies FROM (SELECT machine_id, date_trunc('hour', event_time) AS event_time FROM readings) GROUP BY ALL HAVING count(*) > 1")
def grain_check(x: Context):
    rows = x.facts.readings.select("machine_id", F.date_trunc("hour", "event_time").alias("event_time"))
    return merge.grain_violations(rows, ["machine_id", "event_time"])


