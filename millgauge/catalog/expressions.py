"""Sources, scalar expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, keys
from ..functions.bands import band
from ..functions.numeric import differs, minutes_between, num, null_as_zero, percent, seconds_between
from ..functions.text import clip, contains, mask_email, month_of_partition, report_line, row_json
from ..operators import dimensions
from ..operators.joins import with_as_of
from ..sources import messages, seeds
from .envelope import ENVELOPE_SQL, broken_envelope
from .registry import Context, query
from .sql import keys_of

# ---- sources ------------------------------------------------------------------


@query("src3", f"""WITH env AS ({ENVELOPE_SQL})
SELECT kafka_partition, kafka_offset, CASE WHEN fault IN ('none', 'no_time') THEN machine_id END AS machine_id,
  CASE WHEN fault IN ('none', 'no_machine') THEN event_time END AS event_time,
  CASE WHEN fault IN ('none', 'no_time', 'no_machine') THEN CAST(temperature_c AS DOUBLE) END AS temperature_c
FROM env""")
def parse_payload(x: Context):
    parsed = messages.parse(messages.envelope(broken_envelope(x)))
    return parsed.select("kafka_partition", "kafka_offset", "d.machine_id", "d.event_time", "d.temperature_c")


@query("src4", """SELECT machine_id, event_time, CAST(temperature_c AS DOUBLE) AS temperature_c,
  CAST(power_kw AS DOUBLE) AS power_kw, CAST(vibration_mm_s AS DOUBLE) AS vibration_mm_s, status, units_produced, good_units
FROM readings""")
def parse_and_flatten(x: Context):
    sent = messages.keyed_messages(x.readings.drop("reading_id"), "machine_id")
    return messages.parse_flat(sent)


@query("src5", f"""WITH env AS ({ENVELOPE_SQL})
SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp FROM env""")
def broker_metadata(x: Context):
    return messages.envelope(broken_envelope(x)).drop("raw_payload")


@query("src6", """SELECT r.machine_id, count(*) AS readings, CAST(m.ideal_cycle_time_sec AS DOUBLE) AS ideal_cycle_time_sec
FROM readings r JOIN dim_machine m ON m.machine_id = r.machine_id WHERE m.is_current GROUP BY ALL""")
def dimension_scan(x: Context):
    dim = x.star.machines.where("is_current").select("machine_id", "ideal_cycle_time_sec")
    return x.readings.groupBy("machine_id").agg(F.count("*").alias("readings")).join(dim, "machine_id")


@query("src7", """SELECT DISTINCT machine_key, alert_type_key FROM alerts, newest
WHERE raised_at > as_of - INTERVAL 60 MINUTE""")
def open_alert_keys(x: Context):
    clocked = x.star.alerts.crossJoin(F.broadcast(x.newest()))
    return clocked.where(F.col("raised_at") > F.col("as_of") - F.expr("INTERVAL 60 MINUTES")).select(
        "machine_key", "alert_type_key").distinct()


@query("src8", "SELECT machine_id, started_at FROM stops WHERE ended_at IS NULL")
def open_stops(x: Context):
    return x.star.downtime.where("ended_at IS NULL").select("machine_id", "started_at")


@query("src10", """SELECT s.status_code, s.status_name, s.is_downtime, count(r.reading_id) AS readings
FROM dim_status s LEFT JOIN readings r ON upper(r.status) = s.status_code GROUP BY ALL""")
def seed_rows(x: Context):
    used = x.readings.groupBy(F.upper("status").alias("status_code")).agg(F.count("*").alias("readings"))
    return seeds.statuses(x.spark).join(used, "status_code", "left").select(
        "status_code", "status_name", "is_downtime", null_as_zero("readings").alias("readings"))


@query("src11", """SELECT full_date, count(r.reading_id) AS readings FROM days d
LEFT JOIN readings r ON CAST(r.event_time AS DATE) = d.full_date GROUP BY ALL""")
def date_series(x: Context):
    days = x.readings.groupBy(F.to_date("event_time").alias("full_date")).agg(F.count("*").alias("n"))
    span = dimensions.date_span(days, "full_date")
    return span.join(days, "full_date", "left").select("full_date", null_as_zero("n").alias("readings"))


@query("src12", """SELECT CAST(range AS INTEGER) AS time_key, count(r.reading_id) AS readings FROM range(1440)
LEFT JOIN readings r ON hour(event_time) * 60 + minute(event_time) = range GROUP BY ALL""")
def minute_series(x: Context):
    used = x.readings.groupBy(keys.time_key(F.col("event_time")).cast("int").alias("time_key")).agg(
        F.count("*").alias("n"))
    minutes = x.spark.range(1440).select(F.col("id").cast("int").alias("time_key"))
    return minutes.join(used, "time_key", "left").select("time_key", null_as_zero("n").alias("readings"))


# ---- scalar expressions ---------------------------------------------------------
@query("exp1", f"SELECT reading_id, date_key FROM (SELECT *, {keys_of('event_time')} FROM readings)")
def exp_date_key(x: Context):
    return x.readings.select("reading_id", keys.date_key(F.col("event_time")).alias("date_key"))


@query("exp2", f"SELECT reading_id, time_key FROM (SELECT *, {keys_of('event_time')} FROM readings)")
def exp_time_key(x: Context):
    return x.readings.select("reading_id", keys.time_key(F.col("event_time")).alias("time_key"))


@query("exp3", f"SELECT reading_id, shift_key FROM (SELECT *, {keys_of('event_time')} FROM readings)")
def exp_shift_key(x: Context):
    return x.readings.select("reading_id", keys.shift_key(keys.time_key(F.col("event_time"))).alias("shift_key"))


@query("exp4", """SELECT reading_id, CAST(CASE WHEN temperature_c > 150 OR temperature_c < -20 THEN 2 ELSE 1 END AS SMALLINT) AS flags_key
FROM readings""")
def exp_flags_key(x: Context):
    return x.readings.select("reading_id", keys.flags_key(F.col("temperature_c")).alias("flags_key"))


@query("exp5", "SELECT reading_id, CAST(event_time AS DATE) AS event_date FROM readings")
def exp_event_date(x: Context):
    return x.readings.select("reading_id", F.to_date("event_time").alias("event_date"))


@query("exp6", """SELECT r.reading_id, coalesce(m.machine_key, -1) AS machine_key FROM readings r
LEFT JOIN dim_machine m ON m.machine_id = r.machine_id""")
def exp_unknown_member(x: Context):
    return x.star.conformed.select("reading_id", "machine_key")


@query("exp7", """SELECT reading_id, date_key, time_key, shift_key, flags_key, machine_key, status_key, event_date FROM conformed""")
def exp_conformed_keys(x: Context):
    return x.star.conformed.select("reading_id", "date_key", "time_key", "shift_key", "flags_key", "machine_key",
                                   "status_key", "event_date")


@query("exp8", """SELECT reading_id, coalesce(nullif(units_produced, 0), 0) AS units_produced, coalesce(good_units, 0) AS good_units,
  CAST(5.0 AS DOUBLE) AS runtime_seconds FROM readings""")
def exp_null_units(x: Context):
    holes = x.readings.withColumn("units_produced", F.nullif("units_produced", F.lit(0)))
    return holes.select("reading_id", null_as_zero("units_produced").alias("units_produced"),
                        null_as_zero("good_units").alias("good_units"), F.lit(5.0).alias("runtime_seconds"))


@query("exp9", "SELECT machine_id, started_at, is_open FROM stops")
def exp_generated_flag(x: Context):
    return x.star.downtime.select("machine_id", "started_at", F.col("ended_at").isNull().alias("is_open"))


@query("exp10", "SELECT reading_id, message FROM alerts")
def exp_alert_message(x: Context):
    return x.star.alerts.select("reading_id", "message")


@query("exp11", "SELECT doc_id, substr(text, 1, 4000) AS payload, length(text) AS full_length FROM documents")
def exp_truncate(x: Context):
    return x.table("documents").select("doc_id", clip(F.col("text"), 4000).alias("payload"),
                                       F.length("text").cast("bigint").alias("full_length"))


@query("exp12", f"""WITH env AS ({ENVELOPE_SQL})
SELECT kafka_partition, kafka_offset, CASE fault WHEN 'malformed' THEN 'malformed JSON' WHEN 'empty' THEN 'empty payload'
  WHEN 'no_machine' THEN 'machine_id is null' WHEN 'no_time' THEN 'event_time is null' END AS failure_reason
FROM env WHERE fault <> 'none'""")
def exp_failure_reason(x: Context):
    _, bad = messages.split_valid(messages.parse(messages.envelope(broken_envelope(x))))
    return bad.select("kafka_partition", "kafka_offset", messages.failure_reason().alias("failure_reason"))


@query("exp13", """SELECT reading_id, date_trunc('hour', event_time) AS window_start,
  date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end FROM readings""")
def exp_hour_window(x: Context):
    start = F.date_trunc("hour", "event_time")
    return x.readings.select("reading_id", start.alias("window_start"),
                             (start + F.expr("INTERVAL 1 HOUR")).alias("window_end"))


@query("exp14", "SELECT upper(status) AS status, count(*) AS n FROM readings WHERE lower(status) = 'running' GROUP BY ALL")
def exp_case_insensitive(x: Context):
    return x.readings.where(F.lower("status") == "running").groupBy(F.upper("status").alias("status")).agg(
        F.count("*").alias("n"))


@query("exp15", """SELECT p_partkey, CASE WHEN p_brand ILIKE '%brand#1%' THEN 'LINE-A' WHEN p_brand ILIKE '%brand#2%' THEN 'LINE-B'
  WHEN TRY_CAST(right(p_name, 1) AS INTEGER) <= 3 THEN 'LINE-A' ELSE 'LINE-B' END AS production_line FROM part""")
def exp_pattern_case(x: Context):
    brand = F.regexp_replace("p_brand", "(?i)brand#1", "line a ")
    brand = F.regexp_replace(brand, "(?i)brand#2", "line b ")
    return x.table("part").select("p_partkey",
                                  dimensions.production_line(brand, F.col("p_name")).alias("production_line"))


@query("exp16", """SELECT r.machine_id, count(*) AS readings,
  CASE WHEN upper(m.machine_type) IN ('CNC', 'PRESS') THEN 'HIGH' ELSE 'MEDIUM' END AS criticality
FROM readings r JOIN master m ON m.machine_id = r.machine_id GROUP BY ALL""")
def exp_criticality(x: Context):
    dim = x.star.master.select("machine_id", dimensions.criticality(F.col("machine_type")).alias("criticality"))
    return x.readings.groupBy("machine_id").agg(F.count("*").alias("readings")).join(dim, "machine_id")


PLANNED_REASON = """CASE WHEN {c} ILIKE '%unplanned%' THEN FALSE
  ELSE coalesce({c} ILIKE '%planned%' OR {c} ILIKE '%maintenance%', FALSE) END"""


@query("exp17", f"""SELECT p_partkey, {PLANNED_REASON.format(c="reason")} AS is_planned,
  coalesce(reason ILIKE '%planned%' OR reason ILIKE '%maintenance%', FALSE) AS is_planned_legacy
FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Planned stop ' || p_name WHEN 1 THEN 'UNPLANNED ' || p_type
  WHEN 2 THEN 'Line Maintenance' WHEN 3 THEN p_type END AS reason FROM part)""")
def exp_planned_reason(x: Context):
    from ..plans.migration import planned_reason

    k = F.col("p_partkey") % 5
    reason = (F.when(k == 0, F.concat(F.lit("Planned stop "), "p_name")).when(k == 1, F.concat(F.lit("UNPLANNED "), "p_type"))
              .when(k == 2, "Line Maintenance").when(k == 3, F.col("p_type")))
    rows = x.table("part").select("p_partkey", reason.alias("reason"))
    return rows.select("p_partkey", planned_reason(F.col("reason")).alias("is_planned"),
                       planned_reason(F.col("reason"), legacy=True).alias("is_planned_legacy"))


@query("exp18", """SELECT o_custkey, round(CAST(100 * count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE)
  / nullif(count(*) FILTER (WHERE o_orderpriority LIKE '1%'), 0), 2) AS pct FROM orders GROUP BY ALL""")
def exp_safe_percent(x: Context):
    counted = x.table("orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("a"),
        F.count_if(F.col("o_orderpriority").startswith("1")).alias("b"))
    return counted.select("o_custkey", percent("a", "b").alias("pct"))


@query("exp19", """SELECT machine_id, started_at, (epoch_us(ended_at) - epoch_us(started_at)) / 6e7 AS minutes,
  (epoch_us(ended_at) - epoch_us(started_at)) / 1e6 AS seconds FROM stops""")
def exp_elapsed(x: Context):
    a, b = F.col("started_at"), F.col("ended_at")
    return x.star.downtime.select("machine_id", "started_at", minutes_between(a, b).alias("minutes"),
                                  seconds_between(a, b).alias("seconds"))


@query("exp20", """SELECT reading_id, event_time + INTERVAL 10 MINUTE AS plus_10m, event_time - INTERVAL 24 HOUR AS minus_1d,
  CAST(CAST(event_time AS DATE) + 180 AS DATE) AS review_due FROM readings""")
def exp_intervals(x: Context):
    ts = F.col("event_time")
    return x.readings.select("reading_id", (ts + F.expr("INTERVAL 10 MINUTES")).alias("plus_10m"),
                             (ts - F.expr("INTERVAL 24 HOURS")).alias("minus_1d"),
                             F.date_add(F.to_date(ts), 180).alias("review_due"))


@query("exp21", """SELECT reading_id, CAST(greatest(CASE WHEN status = 'RUNNING' THEN temperature_c END, power_kw) AS DOUBLE) AS top
FROM readings""")
def exp_greatest(x: Context):
    return x.readings.select("reading_id", num(F.greatest(
        F.when(F.col("status") == "RUNNING", F.col("temperature_c")), F.col("power_kw"))).alias("top"))


@query("exp22", """SELECT count(*) AS n, count(*) FILTER (WHERE a IS DISTINCT FROM b) AS changed FROM (
SELECT nullif(units_produced, 0) AS a, nullif(good_units, 0) AS b FROM readings)""")
def exp_distinct_from(x: Context):
    z = F.lit(0)
    return x.readings.agg(F.count("*").alias("n"), F.count_if(
        differs(F.nullif("units_produced", z), F.nullif("good_units", z))).alias("changed"))


@query("exp23", """SELECT reading_id, regexp_replace(coalesce(acknowledged_by, ''), '(.).*(@.*)', '\\1***\\2') AS masked FROM alerts""")
def exp_mask(x: Context):
    return x.star.alerts.select("reading_id", mask_email(F.col("acknowledged_by")).alias("masked"))


CALENDAR_SQL = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(isoyear(d) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS iso_week,
  CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name, strftime(d, '%b %Y') AS month_year,
  CAST(quarter(d) AS INTEGER) AS quarter_number, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, CAST(year(d) AS INTEGER) AS year_number,
  CAST(month(d - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month, CAST(quarter(d - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter,
  CAST(year(d + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year,
  isodow(d) IN (6, 7) AS is_weekend, isodow(d) NOT IN (6, 7) AS is_working_day,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date"""


@query("exp24", f"SELECT o_orderkey, d AS full_date, {CALENDAR_SQL} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def exp_calendar(x: Context):
    rows = x.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return rows.select("o_orderkey", *[c.alias(n) for n, c in calendar.calendar(F.col("d")).items()])


@query("exp25", """SELECT fiscal_year, fiscal_month, count(*) AS orders FROM (
SELECT CAST(year(o_orderdate + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year,
  CAST(month(o_orderdate - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month FROM orders) GROUP BY ALL""")
def exp_fiscal(x: Context):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return x.table("orders").groupBy(calendar.fiscal_year(y, m).alias("fiscal_year"),
                                     calendar.fiscal_month(m).alias("fiscal_month")).agg(F.count("*").alias("orders"))


# First hour of each part of the day; the shifts come from their seed.
DAY_PARTS = ((0, "Night"), (5, "Morning"), (12, "Afternoon"), (17, "Evening"), (21, "Night"))
_PARTS = ", ".join(f"({hour}, '{name}')" for hour, name in DAY_PARTS)

# ``t`` is any moment with the time of day in question.
CLOCK_SQL = f"""CAST(date_diff('minute', date_trunc('day', t), t) AS SMALLINT) AS time_key, strftime(t, '%H:%M:00') AS time_value,
  CAST(hour(t) AS INTEGER) AS hour_24, CAST(strftime(t, '%I') AS INTEGER) AS hour_12, CAST(minute(t) AS INTEGER) AS minute_of_hour,
  strftime(t, '%p') AS am_pm, strftime(t, '%H:00 - ') || strftime(t + INTERVAL 1 HOUR, '%H:00') AS hour_bucket,
  (SELECT arg_max(s.shift_key, begins) FROM (SELECT shift_key, CAST(start_time AS TIME) AS begins FROM dim_shift WHERE shift_key > 0
    UNION ALL SELECT arg_max(shift_key, CAST(start_time AS TIME)), TIME '00:00:00' FROM dim_shift WHERE shift_key > 0) s WHERE begins <= CAST(t AS TIME)) AS shift_key,
  (SELECT arg_max(part, since) FROM (VALUES {_PARTS}) d(since, part) WHERE since <= hour(t)) AS day_part"""


@query("exp26", f"SELECT reading_id, {CLOCK_SQL} FROM (SELECT reading_id, date_trunc('minute', event_time) AS t FROM readings)")
def exp_clock(x: Context):
    m = keys.time_key(F.col("event_time")).cast("int")
    rows = x.readings.select("reading_id", m.alias("m"))
    return rows.select("reading_id", *[c.alias(n) for n, c in calendar.clock(F.col("m")).items()])


@query("exp27", """SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_mktsegment': c_mktsegment}) AS detail FROM customer""")
def exp_row_json(x: Context):
    return x.table("customer").select("c_custkey", row_json("c_custkey", "c_name", "c_mktsegment").alias("detail"))


@query("exp28", """SELECT s_suppkey, rpad(s_name, 30, ' ') || rpad(CAST(s_nationkey AS VARCHAR), 6, ' ') AS line,
  left(s_name, 12) AS cut, concat_ws(' | ', s_name, CAST(s_nationkey AS VARCHAR)) AS piped FROM supplier""")
def exp_report_line(x: Context):
    return x.table("supplier").select(
        "s_suppkey", report_line((F.col("s_name"), 30), (F.col("s_nationkey"), 6)).alias("line"),
        F.left("s_name", F.lit(12)).alias("cut"), F.concat_ws(" | ", "s_name", F.col("s_nationkey").cast("string")).alias("piped"))


@query("exp29", """SELECT DISTINCT 'fact_' || strftime(o_orderdate, '%Y%m') AS name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  date_trunc('month', o_orderdate) < DATE '1996-01-01' AS expired FROM orders""")
def exp_partition_month(x: Context):
    names = x.table("orders").select(F.concat(F.lit("fact_"), F.date_format("o_orderdate", "yyyyMM")).alias("name")).distinct()
    month = month_of_partition(F.col("name"))
    return names.select("name", month.alias("month_start"), (month < F.lit("1996-01-01").cast("date")).alias("expired"))


@query("exp30", """SELECT reading_id, CASE WHEN temperature_c > 120 THEN 'CRITICAL' WHEN temperature_c > 85 THEN 'HIGH' ELSE 'NORMAL' END AS band
FROM readings""")
def exp_band(x: Context):
    t = F.col("temperature_c")
    return x.readings.select("reading_id", band((t > 120, "CRITICAL"), (t > 85, "HIGH"), otherwise="NORMAL").alias("band"))


@query("exp31", """SELECT reading_id, event_time - INTERVAL 3 HOUR AS utc_time FROM readings""")
def exp_to_utc(x: Context):
    return x.readings.select("reading_id", F.to_utc_timestamp("event_time", "+03:00").alias("utc_time"))


@query("exp32", "SELECT reading_id, alert_code, threshold_value FROM candidates")
def exp_typed_null(x: Context):
    from ..operators.alerts import candidates

    return candidates(x.star.conformed).select("reading_id", "alert_code", "threshold_value")


# ---- filters ------------------------------------------------------------------
@query("flt1", f"""WITH env AS ({ENVELOPE_SQL}) SELECT fault = 'none' AS valid, count(*) AS n FROM env GROUP BY ALL""")
def flt_split(x: Context):
    good, bad = messages.split_valid(messages.parse(messages.envelope(broken_envelope(x))))
    n = lambda df, v: df.agg(F.count("*").alias("n")).select(F.lit(v).alias("valid"), "n")
    return n(good, True).unionByName(n(bad, False))


@query("flt3", """SELECT count(*) FILTER (WHERE event_time > as_of - INTERVAL 1 HOUR) AS h1, count(*) FILTER (WHERE event_time > as_of - INTERVAL 6 HOUR) AS h6,
  count(*) FILTER (WHERE event_time > as_of - INTERVAL 24 HOUR) AS h24, count(*) FILTER (WHERE event_time > as_of - INTERVAL 7 DAY) AS d7
FROM readings, newest""")
def flt_lookback(x: Context):
    rows = with_as_of(x.readings, "event_time")
    after = lambda span: F.count_if(F.col("event_time") > F.col("as_of") - F.expr(f"INTERVAL {span}"))
    return rows.agg(after("1 HOUR").alias("h1"), after("6 HOURS").alias("h6"), after("24 HOURS").alias("h24"),
                    after("7 DAYS").alias("d7"))


@query("flt4", """SELECT machine_key, window_start FROM hourly, newest WHERE window_end <= date_trunc('hour', as_of)""")
def flt_closed_hours(x: Context):
    from ..plans.snowflake import closed_hours

    clocked = x.star.hourly.crossJoin(F.broadcast(x.newest()))
    return closed_hours(clocked, F.col("as_of")).select("machine_key", "window_start")


@query("flt5", """SELECT count(*) FILTER (WHERE status IN ('DOWN', 'FAULT')) AS inside, count(*) FILTER (WHERE status NOT IN ('DOWN', 'FAULT')) AS outside,
  count(*) FILTER (WHERE temperature_c BETWEEN 60 AND 85) AS mid FROM readings""")
def flt_membership(x: Context):
    s = F.col("status").isin("DOWN", "FAULT")
    return x.readings.agg(F.count_if(s).alias("inside"), F.count_if(~s).alias("outside"),
                          F.count_if(F.col("temperature_c").between(60, 85)).alias("mid"))


@query("flt2", "SELECT machine_key, machine_id, valid_from FROM versions WHERE is_current AND machine_id IN (SELECT machine_id FROM readings)")
def flt_current(x: Context):
    from .versions import versions

    return versions(x).where("is_current").join(x.readings.select("machine_id").distinct(), "machine_id", "left_semi").select(
        "machine_key", "machine_id", "valid_from")


@query("exp17_text", """SELECT doc_id, coalesce(text ILIKE '%maintenance%', FALSE) AS hit FROM documents""")
def exp_contains(x: Context):
    return x.table("documents").select("doc_id", contains(F.col("text"), "maintenance").alias("hit"))
