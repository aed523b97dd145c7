"""The telemetry streams: current star job and first-generation job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators import alerts, downtime, production
from ..operators.joins import small
from ..operators.sequence import ordered_columns
from ..sources import messages, sinks
from ..sources.store import Store
from . import state

# Declared schemas of the written tables: a table may be read before its first row.
DEAD_LETTERS = (
    "source_batch string, kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, "
    "raw_payload string, failure_reason string, quarantined_at timestamp, replayed_at timestamp"
)
ALERTS = (
    "reading_id bigint, date_key int, time_key smallint, machine_key bigint, alert_type_key smallint, "
    "shift_key smallint, raised_at timestamp, alert_count int, trigger_value double, threshold_value double, "
    "message string"
)
SENSOR = (
    "reading_id bigint, date_key int, time_key smallint, machine_key bigint, status_key smallint, shift_key smallint, flags_key smallint, "
    "event_ts timestamp, event_date date, temperature_c decimal(10,3), power_kw decimal(10,3), vibration_mm_s decimal(10,3), "
    "units_produced int, good_units int, runtime_seconds double"
)
VIOLATIONS = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, raw_payload string, bad_fields array<string>"
_END = "ended_at timestamp, duration_minutes double, is_open boolean"
STOPS = (
    "machine_id string, date_key int, time_key smallint, machine_key bigint, status_key smallint, "
    f"shift_key smallint, started_at timestamp, is_planned boolean, reason_code string, {_END}"
)
STATUS_STOPS = f"event_id bigint, machine_id string, started_at timestamp, reason_code string, {_END}"
STOP_KEYS = ("machine_id", "started_at")
MINUTE_KEYS = ("machine_id", "window_start")
MAX_FOLDERS = 8  # of a partition; with one more the partition is compacted

WATERMARK = "10 minutes"
FIRST_GENERATION_WATERMARK = "2 minutes"
STAR_TRIGGER = "30 seconds"
FIRST_GENERATION_TRIGGER = "10 seconds"
WAIT_SECONDS = 1  # for one query before the next is looked at


def timed(parsed: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event time with the broker's time as fallback, under a watermark."""
    return parsed.withColumn(
        "event_ts", F.coalesce(F.col("d.event_time"), F.col("kafka_timestamp"))
    ).withWatermark("event_ts", delay)


def without_repeats(readings: DataFrame, delay: str = WATERMARK, keys=("event_time", *messages.COORDINATES)) -> DataFrame:
    """Drop telemetry delivered twice, within the watermark. State holds keys only.

    Partitions count their offsets on their own, so an offset names a message only together with topic and partition.
    """
    return readings.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def save_stops(stops: Store, path, opened: DataFrame, closed: DataFrame, before: DataFrame, batch_id: int) -> None:
    """Stop changes of one batch and the open stops it leaves behind. Each is computed once and read back."""
    spark = opened.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        sinks.write_batch(df, path("_changes"), name)
        return spark.read.schema(df.schema).parquet(sinks.batch_path(path("_changes"), name))

    opened, closed = kept(opened, "opened"), kept(closed, "closed")
    stops.append(downtime.as_open(opened), "opened", batch_id, MAX_FOLDERS)
    end = {"duration_minutes": downtime.duration(F.col("started_at"), F.col("ended_at")), "is_open": F.lit(False)}
    first = closed.groupBy(*STOP_KEYS).agg(F.min("ended_at").alias("ended_at"))
    stops.update(first.withColumns(end), STOP_KEYS, ("ended_at", "duration_minutes", "is_open"), F.col("is_open"), "closed", batch_id)
    state.save_state(downtime.still_open(before, opened, closed), path("open_stops"), batch_id)


@dataclass
class StarJob:
    """Where the stream writes and what it looks up."""

    base: str
    machines: DataFrame
    statuses: DataFrame
    alert_types: DataFrame
    rearm_minutes: float = alerts.REARM_MINUTES
    reading_seconds: int = production.READING_SECONDS
    topics: tuple[str, ...] = ("iot-sensor-data",)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def store(self, name: str, schema: str | None = None, ts: str = "") -> Store:
        spark = self.machines.sparkSession
        return Store.open(spark, self.path(name)) if schema is None else Store(spark, self.path(name), schema, ts)

    # ---- one micro-batch ----
    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Write every fact of one batch from a single persisted input. A batch that is run again changes nothing."""
        spark = batch.sparkSession
        started = dt.datetime.now(dt.timezone.utc)
        offsets = state.state_before(spark, self.path("offsets"), state.OFFSETS, batch_id)
        batch = messages.not_seen(batch, offsets).persist()
        try:
            valid, invalid = messages.split_valid(batch)
            self.store("dead_letters", DEAD_LETTERS, "quarantined_at").append(
                messages.dead_letters(invalid, batch_id), "stream", batch_id, MAX_FOLDERS)
            bad = messages.field_violations(batch)
            self.store("violations", VIOLATIONS, "kafka_timestamp").append(bad, "stream", batch_id, MAX_FOLDERS)
            rows = valid.select("d.*", messages.message_id(self.topics).alias("reading_id"))
            if rows.isEmpty():
                self._carry(spark, batch_id)
                state.save_state(messages.next_offsets(batch, offsets), self.path("offsets"), batch_id)
                return
            conformed = production.conform(rows, self.machines, self.statuses).persist()
            try:
                self._facts(conformed, batch_id)
                written = conformed.count()
            finally:
                conformed.unpersist()
            state.save_state(messages.next_offsets(batch, offsets), self.path("offsets"), batch_id)
            sinks.log_batch(spark, self.path("batch_log"), "star_stream", str(batch_id), started, "SUCCESS", written)
        except Exception as exc:
            sinks.log_batch(spark, self.path("batch_log"), "star_stream", str(batch_id), started, "FAILED", error=str(exc))
            raise
        finally:
            batch.unpersist()

    def _carry(self, spark, batch_id: int) -> None:
        """A batch without valid rows hands the state on unchanged."""
        for name, schema in (("open_stops", state.OPEN_STOPS), ("last_seen", state.LAST_SEEN)):
            before = state.state_before(spark, self.path(name), schema, batch_id)
            state.save_state(before, self.path(name), batch_id)

    def _facts(self, conformed: DataFrame, batch_id: int) -> None:
        self.store("sensor", SENSOR, "event_ts").append(
            production.sensor_fact(conformed, self.reading_seconds), "stream", batch_id, MAX_FOLDERS)
        # Partial sums of this batch; compaction adds up those of an hour, readers the few that are left.
        parts = production.hourly_components(conformed, self.reading_seconds)
        Store.like(parts, self.path("hourly_parts"), "window_start").append(
            parts, "stream", batch_id, MAX_FOLDERS, production.merge_components)
        self._alerts(conformed, batch_id)
        self._downtime(conformed, batch_id)

    def _alerts(self, conformed: DataFrame, batch_id: int) -> None:
        spark = conformed.sparkSession
        keys = ["machine_id", "alert_code"]
        seen = state.state_before(spark, self.path("last_seen"), state.LAST_SEEN, batch_id)
        cands = alerts.candidates(conformed)
        marked = ordered_columns(cands, keys, "event_time", ["reading_id"], lag={"_prev_ts": F.col("event_time")})
        # A row older than the state is judged within its batch: the state says nothing about the time before it.
        before = F.when(F.col("last_seen") <= F.col("event_time"), F.col("last_seen"))
        marked = marked.join(small(seen), keys, "left").withColumn("_prev_ts", F.coalesce("_prev_ts", before))
        quiet = F.unix_micros("event_time") - F.unix_micros("_prev_ts")
        kept = marked.where(F.col("_prev_ts").isNull() | (quiet > int(self.rearm_minutes * 60_000_000)))
        self.store("alerts", ALERTS, "raised_at").append(
            alerts.alert_fact(kept.drop("_prev_ts", "last_seen"), self.alert_types), "stream", batch_id, MAX_FOLDERS)
        newest = cands.groupBy(*keys).agg(F.max("event_time").alias("last_seen"))
        after = newest.unionByName(seen).groupBy(*keys).agg(F.max("last_seen").alias("last_seen"))
        state.save_state(after, self.path("last_seen"), batch_id)

    def _downtime(self, conformed: DataFrame, batch_id: int) -> None:
        before = state.state_before(conformed.sparkSession, self.path("open_stops"), state.OPEN_STOPS, batch_id)
        opened, closed = downtime.batch_changes(conformed, before)
        save_stops(self.store("stops", STOPS, "started_at"), self.path, opened, closed, before, batch_id)

    # ---- tables as readers see them ----
    def sensor(self, spark) -> DataFrame:
        return self.store("sensor", SENSOR, "event_ts").read()

    def hourly(self, spark) -> DataFrame:
        return production.finish_hourly(production.merge_components(self.store("hourly_parts").read()))

    def alert_fact(self, spark) -> DataFrame:
        return self.store("alerts", ALERTS, "raised_at").read()

    def downtime_fact(self, spark) -> DataFrame:
        return self.store("stops", STOPS, "started_at").read()

    def dead_letters(self, spark) -> DataFrame:
        return self.store("dead_letters", DEAD_LETTERS, "quarantined_at").read()

    def violations(self, spark) -> DataFrame:
        return self.store("violations", VIOLATIONS, "kafka_timestamp").read()

    def cache_dimensions(self) -> None:
        """Load the dimensions once for all batches; they are small and change rarely."""
        for name in ("machines", "statuses", "alert_types"):
            cached = getattr(self, name).cache()
            cached.count()
            setattr(self, name, cached)

    def start(self, raw: DataFrame, once: bool = False) -> StreamingQuery:
        """Start on broker-shaped rows. ``once`` works off what is there and stops."""
        parsed = timed(messages.parse(messages.envelope(raw)))
        writer = (
            parsed.writeStream.foreachBatch(self.process)
            .outputMode("append")
            .option("checkpointLocation", self.path("_checkpoint"))
        )
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=STAR_TRIGGER)
        return writer.start()


@dataclass
class FirstGenerationJob:
    """Raw readings, one-minute indicators, and alerts with stops as three queries."""

    base: str

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _start(self, df: DataFrame, name: str, mode: str, write, once: bool) -> StreamingQuery:
        writer = (
            df.writeStream.queryName(f"first_generation_{name}_{abs(hash(self.base))}")
            .foreachBatch(write)
            .outputMode(mode)
            .option("checkpointLocation", self.path(f"_checkpoint_{name}"))
        )
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=FIRST_GENERATION_TRIGGER)
        return started(writer, df.sparkSession)

    def start_readings(self, readings: DataFrame, once: bool = False) -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            Store.like(batch, self.path("readings"), "event_time").append(batch, "stream", batch_id, MAX_FOLDERS)

        return self._start(readings, "readings", "append", write, once)

    def start_minutes(self, readings: DataFrame, once: bool = False, delay: str = FIRST_GENERATION_WATERMARK, unit: str = "yyyyMMdd") -> StreamingQuery:
        """Update mode: every change of a minute replaces its row, so there is one row a minute however many batches came.

        Rows behind the watermark no longer change a minute. A batch rewrites the partitions (``unit``) of the minutes it changes.
        """
        kpis = production.minute_kpis(readings.withWatermark("event_time", delay))

        def write(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()  # the aggregate's state is read once
            try:
                Store.like(batch, self.path("minutes"), "window_start", unit).upsert(batch, MINUTE_KEYS, "stream", batch_id)
            finally:
                batch.unpersist()

        return self._start(kpis, "minutes", "update", write, once)

    def start_alerts(self, readings: DataFrame, once: bool = False) -> StreamingQuery:
        """Exclusive alerts and stops; the previous status lives in a state table, not in the driver."""

        def write(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            batch = batch.persist()
            try:
                raised = alerts.exclusive_alerts(batch)
                Store.like(raised, self.path("alerts"), "event_time").append(raised, "stream", batch_id, MAX_FOLDERS)
                before = state.state_before(spark, self.path("open_stops"), state.OPEN_STOPS, batch_id)
                opened, closed = downtime.status_changes(batch, before)
                save_stops(Store(spark, self.path("stops"), STATUS_STOPS, "started_at"), self.path, opened, closed, before, batch_id)
            finally:
                batch.unpersist()

        return self._start(readings, "alerts", "append", write, once)

    def readings(self, spark) -> DataFrame:
        return Store.open(spark, self.path("readings")).read()

    def alerts(self, spark) -> DataFrame:
        return Store.open(spark, self.path("alerts")).read()

    def stops(self, spark) -> DataFrame:
        return Store(spark, self.path("stops"), STATUS_STOPS, "started_at").read()

    def minutes(self, spark) -> DataFrame:
        return Store.open(spark, self.path("minutes")).read()

    def start(self, readings: DataFrame, once: bool = False) -> list[StreamingQuery]:
        return [
            self.start_readings(readings, once),
            self.start_minutes(readings, once),
            self.start_alerts(readings, once),
        ]


def started(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start with a partition of state for each core. Every partition costs a task with its files and its report to the driver in every
    batch, however few keys it holds; a query keeps the number it starts with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)


def wait_for(queries: list[StreamingQuery]) -> None:
    """Wait for all queries; a failure of any one surfaces here."""
    running = list(queries)
    while running:
        running = [q for q in running if not q.awaitTermination(WAIT_SECONDS)]  # raises what the query raised


def replayable(letters: DataFrame, reason: str | None = None) -> DataFrame:
    """Quarantined messages not sent again yet, optionally of one reason."""
    out = letters.where("replayed_at IS NULL")
    return out.where(F.col("failure_reason") == reason) if reason else out


def replay(letters: DataFrame, corrected: DataFrame, at) -> tuple[DataFrame, DataFrame]:
    """(messages, letters): corrected payloads as keyed messages, and the queue with
    those that parse now marked as replayed.

    ``corrected`` has the broker coordinates and the new ``raw_payload``.
    """
    coords = ["kafka_topic", "kafka_partition", "kafka_offset"]
    parsed = messages.parse(corrected)
    good, _ = messages.split_valid(parsed)
    waiting = replayable(letters).select(*coords)
    good = good.join(waiting, coords, "left_semi")
    sent = good.select(F.col("d.machine_id").alias("key"), F.col("raw_payload").alias("value"))
    done = good.select(*coords, F.lit(True).alias("_sent"))
    marked = letters.join(done, coords, "left").withColumn(
        "replayed_at", F.when(F.col("_sent") & F.col("replayed_at").isNull(), at).otherwise(F.col("replayed_at"))
    ).select(*letters.columns)
    return sent, marked
