"""Streams over the readings, and what their sinks hold afterwards.

The given events table is the stream's source: its readings are cut into chunks of days that arrive as
files, in order, late or repeated, and a batch takes one chunk. Each run works off the available files and stops; the
result is read back from the written tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..functions.numeric import num
from ..operators import alerts, production
from ..operators.sequence import first_per
from ..sources import messages, sinks, tables
from ..sources.store import Store
from ..streaming import jobs
from .aggregates import HOURLY_OUT, MINUTE_OUT, MINUTE_SQL
from .envelope import CHUNK_SQL, ENVELOPE_SQL, FEED_FILES, LATE_SQL, feed_stream, files_per_batch, to_envelope, write_feed
from .registry import REARM_MINUTES, Context, once, query

def reading_stream(x: Context):
    return tables.telemetry(tables.table_stream(x.spark, x.folder, "events"))


def feed(x: Context, kind: str = "ordered", files: int | None = FEED_FILES):
    """Stream over the readings as they arrive; a batch takes ``files`` files, those of one chunk by default. With None it takes as many
    chunks as keep the number of batches bounded."""
    def write() -> tuple[str, int]:
        path = x.path(f"feed_{kind}")
        return path, write_feed(x, path, kind)

    path, chunks = once(x, f"feed_{kind}", write)
    return feed_stream(x, path, files or files_per_batch(chunks))


def star_run(x: Context) -> jobs.StarJob:
    """A batch for each chunk; a seventh of the messages comes twice in its batch and again in the next."""
    def start() -> jobs.StarJob:
        job = jobs.StarJob(x.path("star"), x.star.machines, x.star.statuses, x.star.alert_types, REARM_MINUTES)
        jobs.wait_for([job.start(to_envelope(feed(x, "repeated"), broken=True), once=True)])
        return job

    return once(x, "star", start)


def first_run(x: Context) -> jobs.FirstGenerationJob:
    def start() -> jobs.FirstGenerationJob:
        job = jobs.FirstGenerationJob(x.path("first"))
        jobs.wait_for(job.start(feed(x, files=None), once=True))
        return job

    return once(x, "first", start)


def late_run(x: Context) -> tuple[jobs.FirstGenerationJob, str]:
    """Minutes of a feed with late rows, in update mode and, in a table of their own, in append mode."""
    def start():
        job = jobs.FirstGenerationJob(x.path("late"))
        path = job.path("appended")
        kpis = production.minute_kpis(feed(x, "late").withWatermark("event_time", jobs.FIRST_GENERATION_WATERMARK))
        append = jobs.started(kpis.writeStream.outputMode("append").format("parquet").option("path", path)
                              .option("checkpointLocation", job.path("_checkpoint_appended")).trigger(availableNow=True), x.spark)
        jobs.wait_for([job.start_minutes(feed(x, "late"), once=True), append])
        return job, path

    return once(x, "late", start)


# The stream drops the broken messages; the same relations over the rest.
_GOOD = "good AS (SELECT c.* FROM conformed c WHERE reading_id % 97 NOT IN (5, 11, 23, 41))"


@query("st1", f"""WITH env AS ({ENVELOPE_SQL}) SELECT kafka_partition, kafka_offset, coalesce(CASE WHEN fault IN ('none', 'no_machine') THEN event_time END, kafka_timestamp) AS event_ts FROM env""")
def event_time(x: Context):
    def start():
        path = x.path("timed")
        parsed = jobs.timed(messages.parse(messages.envelope(to_envelope(reading_stream(x), broken=True))))
        q = (parsed.select("kafka_partition", "kafka_offset", "event_ts").writeStream.outputMode("append").format("parquet")
             .option("path", path).option("checkpointLocation", path + "_checkpoint").trigger(availableNow=True).start())
        jobs.wait_for([q])
        return path

    return x.spark.read.parquet(once(x, "timed", start))


# Rows of the late feed: their own chunk, the one that delivers them, and the watermark that batch tells late rows by. It comes from the
# batches before the last one: a batch still takes what the previous batch's watermark let through.
_DELIVERED = f"""delivered AS (SELECT *, {CHUNK_SQL} + {LATE_SQL} AS batch, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS minute_end FROM readings),
marks AS (SELECT b.batch, (SELECT max(event_time) FROM delivered d WHERE d.batch < b.batch - 1) - INTERVAL 2 MINUTE AS mark FROM (SELECT DISTINCT batch FROM delivered) b),
counted AS (SELECT d.*, mark IS NULL OR minute_end > mark AS in_time FROM delivered d JOIN marks USING (batch))"""


@query("st2", f"""WITH {_DELIVERED} SELECT machine_id, date_trunc('minute', event_time) AS window_start, count(*) AS reading_count,
  CAST(sum(units_produced) AS BIGINT) AS units_produced FROM counted WHERE in_time GROUP BY ALL""")
def watermarked(x: Context):
    """Rows behind the watermark change no minute, those that are only a chunk late do."""
    return late_run(x)[0].minutes(x.spark).select("machine_id", "window_start", "reading_count", "units_produced")


@query("st3", MINUTE_SQL)
def minute_stream(x: Context):
    return first_run(x).minutes(x.spark).select(*MINUTE_OUT)


@query("st3_rows", "SELECT count(*) AS stored_rows, CAST(sum(reading_count) AS BIGINT) AS readings FROM minutes")
def minutes_stored(x: Context):
    """One row is stored for a minute, however often it was emitted."""
    return first_run(x).minutes(x.spark).agg(F.count("*").alias("stored_rows"), F.sum("reading_count").alias("readings"))


@query("st4", f"""WITH {_DELIVERED} SELECT machine_id, count(*) AS delivered, count(*) FILTER (WHERE in_time) AS counted,
  count(*) FILTER (WHERE NOT in_time) AS too_late FROM counted GROUP BY ALL""")
def late_rows(x: Context):
    counted = late_run(x)[0].minutes(x.spark).groupBy("machine_id").agg(F.sum("reading_count").alias("counted"))
    all_rows = x.readings.groupBy("machine_id").agg(F.count("*").alias("delivered"))
    return all_rows.join(counted, "machine_id", "left").select(
        "machine_id", "delivered", F.coalesce("counted", F.lit(0)).alias("counted"), (F.col("delivered") - F.coalesce("counted", F.lit(0))).alias("too_late"))


@query("st8", f"""WITH {_DELIVERED}, m AS (SELECT machine_id, minute_end, count(*) AS n FROM counted WHERE in_time GROUP BY ALL)
SELECT 'update' AS mode, count(*) AS minutes, CAST(sum(n) AS BIGINT) AS readings FROM m
UNION ALL SELECT 'append', count(*), CAST(sum(n) AS BIGINT) FROM m, (SELECT max(event_time) - INTERVAL 2 MINUTE AS mark FROM readings) WHERE minute_end <= mark""")
def output_modes(x: Context):
    """Append only emits minutes that the watermark has closed; update emits the open ones too."""
    job, path = late_run(x)
    count = lambda df, mode: df.agg(F.lit(mode).alias("mode"), F.count("*").alias("minutes"), F.sum("reading_count").alias("readings"))
    return count(job.minutes(x.spark), "update").unionByName(count(x.spark.read.parquet(path), "append"))


@query("st5", f"""WITH {_GOOD} SELECT machine_key, status_key, shift_key, flags_key, event_time AS event_ts, units_produced FROM good""")
def fan_out(x: Context):
    return star_run(x).sensor(x.spark).select("machine_key", "status_key", "shift_key", "flags_key", "event_ts", "units_produced")


@query("st10", f"""WITH {_GOOD} SELECT machine_key, date_trunc('hour', event_time) AS window_start, count(*) AS reading_count, CAST(sum(units_produced) AS BIGINT) AS units_produced,
  CAST(5 * count(*) FILTER (WHERE is_productive) AS DOUBLE) / 60 AS runtime_minutes, CAST(sum(temperature_c) AS DOUBLE) AS temp_sum FROM good GROUP BY ALL""")
def stream_static(x: Context):
    return star_run(x).hourly(x.spark).select(*HOURLY_OUT).select(
        "machine_key", "window_start", "reading_count", "units_produced", "runtime_minutes", num("temp_sum").alias("temp_sum"))


@query("st12", f"""WITH env AS ({ENVELOPE_SQL}) SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, CASE fault WHEN 'malformed' THEN 'malformed JSON'
  WHEN 'empty' THEN 'empty payload' WHEN 'no_machine' THEN 'machine_id is null' WHEN 'no_time' THEN 'event_time is null' END AS failure_reason FROM env WHERE fault <> 'none'""")
def dead_letters(x: Context):
    return star_run(x).dead_letters(x.spark).select("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "failure_reason")


@query("st13", "SELECT reading_id, alert_code, trigger_value, threshold_value FROM candidates")
def independent_rules(x: Context):
    return alerts.candidates(x.star.conformed).select("reading_id", "alert_code", "trigger_value", "threshold_value")


@query("st14", "SELECT alert_id, machine_id, event_time, alert_type, severity, message FROM failure_alerts")
def exclusive_rules(x: Context):
    return first_run(x).alerts(x.spark)


@query("st15", f"""WITH {_GOOD}, c AS (SELECT machine_id, machine_key, event_time, reading_id, 'FAULT_STATUS' AS code FROM good WHERE upper(status) IN ('FAULT', 'DOWN')
UNION ALL SELECT machine_id, machine_key, event_time, reading_id, 'HIGH_TEMP' FROM good WHERE temperature_c > 85
UNION ALL SELECT machine_id, machine_key, event_time, reading_id, 'HIGH_VIBRATION' FROM good WHERE vibration_mm_s > 4.5)
SELECT machine_key, a.alert_type_key, event_time AS raised_at, 'Machine ' || machine_id || ' raised ' || code AS message
FROM (SELECT *, lag(event_time) OVER (PARTITION BY machine_id, code ORDER BY event_time, reading_id) AS p FROM c) JOIN dim_alert_type a ON a.alert_code = code
WHERE p IS NULL OR event_time - p > INTERVAL 60 MINUTE""")
def alert_stream(x: Context):
    return star_run(x).alert_fact(x.spark).select("machine_key", "alert_type_key", "raised_at", "message")


@query("st15_batch", "SELECT reading_id, machine_key, alert_type_key, raised_at, trigger_value, threshold_value, message FROM alerts")
def alert_batch(x: Context):
    return x.star.alerts.select("reading_id", "machine_key", "alert_type_key", "raised_at", "trigger_value", "threshold_value", "message")


@query("st15_first", """SELECT machine_key, alert_type_key, min(event_time) AS raised_at FROM candidates c JOIN dim_alert_type a ON a.alert_code = c.alert_code
GROUP BY ALL""")
def first_per_batch(x: Context):
    """First alert of each machine and rule, as an aggregate over the candidates."""
    first = first_per(alerts.candidates(x.star.conformed), ["machine_key", "alert_code"], ["event_time", "reading_id"])
    return alerts.alert_fact(first, x.star.alert_types).select("machine_key", "alert_type_key", "raised_at")


@query("st16", f"""WITH {_GOOD}, d AS (SELECT *, coalesce(is_downtime, FALSE) OR upper(status) IN ('DOWN', 'FAULT') AS down FROM good),
ch AS (SELECT *, lead(event_time) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS ended_at FROM (
  SELECT *, lag(down) OVER (PARTITION BY machine_id ORDER BY event_time, reading_id) AS was FROM d) WHERE down <> coalesce(was, FALSE))
SELECT machine_id, event_time AS started_at, ended_at, round((epoch_us(ended_at) - epoch_us(event_time)) / 6e7, 2) AS duration_minutes, ended_at IS NULL AS is_open, upper(status) AS reason_code FROM ch WHERE down""")
def downtime_stream(x: Context):
    return star_run(x).downtime_fact(x.spark).select("machine_id", "started_at", "ended_at", "duration_minutes", "is_open", "reason_code")


@query("st17", "SELECT event_id, machine_id, start_time, end_time, duration_minutes, reason_code FROM downtime_events")
def state_machine(x: Context):
    return x.star.downtime_events


@query("st17_stream", "SELECT event_id, machine_id, start_time AS started_at, end_time AS ended_at, duration_minutes, reason_code FROM downtime_events")
def state_machine_stream(x: Context):
    return first_run(x).stops(x.spark).select("event_id", "machine_id", "started_at", "ended_at", "duration_minutes", "reason_code")


@query("st18", """SELECT 'readings' AS sink, count(*) AS rows FROM readings UNION ALL SELECT 'minutes', count(*) FROM minutes UNION ALL SELECT 'alerts', count(*) FROM failure_alerts""")
def several_queries(x: Context):
    job = first_run(x)
    n = lambda df, name: df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("sink"), "rows")
    return n(job.readings(x.spark), "readings").unionByName(n(job.minutes(x.spark), "minutes")).unionByName(n(job.alerts(x.spark), "alerts"))


@query("st19", f"WITH {_GOOD} SELECT machine_key, count(*) AS readings, count(DISTINCT reading_id) AS messages FROM good GROUP BY ALL")
def repeats_removed(x: Context):
    """Messages that come again, in their batch or in the next, count once; numbers of messages do not collide."""
    return star_run(x).sensor(x.spark).groupBy("machine_key").agg(F.count("*").alias("readings"), F.countDistinct("reading_id").alias("messages"))


@query("st19_watermark", "SELECT machine_id, count(*) AS readings FROM readings GROUP BY ALL")
def repeats_within_watermark(x: Context):
    """The form for sources without offsets in order: every message is delivered twice, state holds keys up to the watermark."""
    def start():
        path = x.path("unique")
        twice = to_envelope(feed(x), broken=False).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
        rows = messages.parse(messages.envelope(twice)).select("d.*", *messages.COORDINATES)
        q = (jobs.without_repeats(rows).writeStream.outputMode("append").format("parquet").option("path", path)
             .option("checkpointLocation", path + "_checkpoint").trigger(availableNow=True).start())
        jobs.wait_for([q])
        return path

    return x.spark.read.parquet(once(x, "unique", start)).groupBy("machine_id").agg(F.count("*").alias("readings"))


@query("st20", f"""WITH env AS ({ENVELOPE_SQL}) SELECT CASE fault WHEN 'malformed' THEN 'malformed JSON' WHEN 'empty' THEN 'empty payload' WHEN 'no_machine' THEN 'machine_id is null'
  ELSE 'event_time is null' END AS failure_reason, fault IN ('malformed', 'no_time') AS replayed, count(*) AS messages FROM env WHERE fault <> 'none' GROUP BY ALL""")
def replay(x: Context):
    """Corrected payloads for two kinds of failure; only those are marked."""
    letters = star_run(x).dead_letters(x.spark)
    fixed = messages.envelope(to_envelope(x.readings, broken=False))
    wanted = letters.where(F.col("failure_reason").isin("malformed JSON", "event_time is null")).select(
        "kafka_topic", "kafka_partition", "kafka_offset")
    corrected = fixed.join(wanted, ["kafka_topic", "kafka_partition", "kafka_offset"], "left_semi")
    _, marked = jobs.replay(letters, corrected, F.current_timestamp())
    return marked.groupBy("failure_reason", F.col("replayed_at").isNotNull().alias("replayed")).agg(F.count("*").alias("messages"))


# ---- sinks ------------------------------------------------------------------
@query("snk1", "SELECT event_date, count(*) AS rows, CAST(sum(units_produced) AS BIGINT) AS units FROM sensor GROUP BY ALL")
def append_batches(x: Context):
    """Six batches into days, each delivered twice; days with more than two folders are compacted, rows stay the same."""
    sensor = x.star.sensor
    table = Store.like(sensor, x.path("sensor"), "event_ts", "yyyyMMdd")
    for batch in range(6):
        for _ in range(2):
            table.append(sensor.where(F.col("reading_id") % 6 == batch), "stream", batch, max_folders=2)
    if max(r.folders for r in table.partitions().collect()) > 2:
        raise AssertionError("a day with more folders than allowed")
    return table.read().groupBy("event_date").agg(F.count("*").alias("rows"), F.sum("units_produced").alias("units"))


@query("snk2", "SELECT machine_id, count(*) AS rows FROM readings GROUP BY ALL")
def raw_append(x: Context):
    return first_run(x).readings(x.spark).groupBy("machine_id").agg(F.count("*").alias("rows"))


@query("snk3", "SELECT machine_key, count(*) AS hours FROM hourly GROUP BY ALL")
def staging(x: Context):
    """Staging is replaced as a whole."""
    path = x.path("staging")
    x.star.hourly.limit(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    x.star.hourly.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return x.spark.read.parquet(path).groupBy("machine_key").agg(F.count("*").alias("hours"))


@query("snk4", "SELECT count(*) AS rows, min(event_ts) AS first_ts, max(event_ts) AS last_ts FROM sensor WHERE event_ts >= TIMESTAMP '2024-01-10' AND event_ts < TIMESTAMP '2024-01-20'")
def monthly_fact(x: Context):
    path = x.path("sensor_by_month")
    sinks.write_monthly(x.star.sensor, path, "event_ts")
    rows = tables.read_months(x.spark, path, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    return rows.agg(F.count("*").alias("rows"), F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))


@query("snk6", f"""WITH {_GOOD} SELECT 'star_stream' AS job_name, CAST({CHUNK_SQL} AS VARCHAR) AS batch_id, 'SUCCESS' AS status, count(*) AS rows_written
FROM good GROUP BY ALL""")
def lineage(x: Context):
    log = x.spark.read.parquet(star_run(x).path("batch_log"))
    return log.select("job_name", "batch_id", "status", "rows_written")


@query("snk7", """SELECT 'load' AS job_name, 'a' AS batch_id, 'SUCCESS' AS status, (SELECT count(*) FROM readings) AS rows_written, CAST(NULL AS VARCHAR) AS error_detail
UNION ALL SELECT 'load', 'b', 'FAILED', NULL, 'it''s broken'""")
def job_lineage(x: Context):
    path, out = x.path("log"), x.path("loaded")

    def load() -> int:
        x.readings.write.parquet(out)
        return x.spark.read.parquet(out).count()

    def fail() -> int:
        raise ValueError("it's broken")

    sinks.run_logged(x.spark, path, "load", "a", load)
    try:
        sinks.run_logged(x.spark, path, "load", "b", fail)
    except ValueError:
        pass
    return sinks.run_outcomes(x.spark.read.parquet(path)).select("job_name", "batch_id", "status", "rows_written", "error_detail")


@query("snk8", """SELECT machine_id AS key, to_json({'machine_id': machine_id, 'status': status, 'units_produced': units_produced}) AS value FROM readings""")
def keyed_sink(x: Context):
    return messages.keyed_messages(x.readings.select("machine_id", "status", "units_produced"), "machine_id")


# ---- stream settings ------------------------------------------------------------
def _stream(x: Context, name: str, rows, timed: bool = False):
    """Work off a stream into a stored table of readings: the table, and the progress of its batches."""
    path = x.path(name)

    def append(batch, batch_id: int) -> None:
        Store.like(batch, path, "event_time").append(batch, "stream", batch_id)

    def run(sink=append):
        writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", path + "/_checkpoint")
        if not timed:
            q = writer.trigger(availableNow=True).start()
            jobs.wait_for([q])
            return q
        q = writer.trigger(processingTime="1 second").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return q

    return path, append, run


_PER_MACHINE = "SELECT machine_id, count(*) AS readings FROM readings GROUP BY ALL"


def _per_machine(df):
    return df.groupBy("machine_id").agg(F.count("*").alias("readings"))


def _busy(q) -> int:
    return sum(p["numInputRows"] > 0 for p in q.recentProgress)


@query("st6", _PER_MACHINE)
def timed_trigger(x: Context):
    def start():
        path, _, run = _stream(x, "timed_trigger", feed(x), timed=True)
        run()
        return path

    return _per_machine(Store.open(x.spark, once(x, "timed_trigger", start)).read())


@query("st7", f"""SELECT machine_id, count(*) AS readings, (SELECT max({CHUNK_SQL}) - 2 FROM readings) AS batches_left FROM readings GROUP BY machine_id""")
def restarted(x: Context):
    """The run dies in its third batch, after the rows were stored and before the checkpoint knew. The next run starts
    with that batch again, which the table already knows and does not read; nothing is lost, nothing counts twice."""
    def start():
        path, append, run = _stream(x, "restarted", feed(x))

        def dies(batch, batch_id: int) -> None:
            append(batch, batch_id)
            if batch_id == 2:
                raise RuntimeError("lost in the third batch")

        try:
            run(dies)
        except StreamingQueryException as exc:
            if "lost in the third batch" not in str(exc):
                raise
        return path, _busy(run())

    path, left = once(x, "restarted", start)
    return _per_machine(Store.open(x.spark, path).read()).withColumn("batches_left", F.lit(left).cast("bigint"))


@query("st9", f"""SELECT CAST(ceil({FEED_FILES} * (SELECT count(DISTINCT {CHUNK_SQL}) FROM readings) / 3.0) AS BIGINT) AS batches, count(*) AS readings FROM readings""")
def rate_limited(x: Context):
    """A backlog of files under a cap of three a batch."""
    def start():
        path, _, run = _stream(x, "rate_limited", feed(x, files=3))
        return path, _busy(run())

    path, batches = once(x, "rate_limited", start)
    return Store.open(x.spark, path).read().agg(F.lit(batches).cast("bigint").alias("batches"), F.count("*").alias("readings"))


@query("st11", "SELECT 'malformed JSON' AS failure_reason, count(*) AS messages FROM readings")
def nothing_valid(x: Context):
    """A stream of broken messages only: all set aside, no facts, no failure."""
    def start() -> jobs.StarJob:
        job = jobs.StarJob(x.path("all_broken"), x.star.machines, x.star.statuses, x.star.alert_types, REARM_MINUTES)
        broken = to_envelope(reading_stream(x), broken=False).withColumn("value", F.concat(F.lit("<"), F.col("value")))
        jobs.wait_for([job.start(broken, once=True)])
        return job

    return once(x, "all_broken", start).dead_letters(x.spark).groupBy("failure_reason").agg(F.count("*").alias("messages"))


@query("src9", "SELECT machine_key, status_key, count(*) AS readings FROM conformed GROUP BY ALL")
def cached_dimensions(x: Context):
    job = jobs.StarJob(x.path("cached"), x.star.machines, x.star.statuses, x.star.alert_types)
    job.cache_dimensions()
    rows = production.conform(x.readings, job.machines, job.statuses)
    return rows.groupBy("machine_key", "status_key").agg(F.count("*").alias("readings"))
