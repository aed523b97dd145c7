"""Streams cut into several batches must end where the batch form ends."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millgauge.catalog.envelope import to_envelope
from millgauge.operators import production
from millgauge.session import scratch_path
from millgauge.sources import messages, sinks
from millgauge.streaming import jobs


@pytest.fixture
def star(spark):
    """Readings of the first six days only: six files are batches enough."""
    from conftest import SMALL
    from millgauge.plans.star import Star
    from millgauge.sources import tables

    events = tables.table(spark, SMALL, "events").where("ts < '2024-01-07'")
    return Star(tables.telemetry(events), rearm_minutes=60)


def daily_files(spark, star, broken=False):
    """Envelope files, one per day, so that episodes cross batches."""
    path = scratch_path(spark, "messages")
    rows = to_envelope(star.readings, broken)
    days = sorted(r[0] for r in rows.select(F.to_date("timestamp")).distinct().collect())
    for i, day in enumerate(days):
        part = rows.where(F.to_date("timestamp") == F.lit(day)).coalesce(1)
        part.write.mode("append").option("timestampFormat", messages.JSON_OPTIONS["timestampFormat"]).json(path)
    return path, len(days)


def keyed(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_star_stream_equals_batch(spark, star):
    path, days = daily_files(spark, star)
    job = jobs.StarJob(scratch_path(spark, "star"), star.machines, star.statuses, star.alert_types, 60)
    job.cache_dimensions()
    raw = messages.file_stream(spark, path, files_per_trigger=1)
    jobs.wait_for([job.start(raw, once=True)])

    log = spark.read.parquet(job.path("batch_log"))
    assert log.where("status = 'SUCCESS'").count() >= days - 1
    cols = ("machine_key", "window_start", "reading_count", "units_produced", "runtime_minutes", "temp_sum")
    assert keyed(job.hourly(spark), *cols) == keyed(star.hourly, *cols)
    cols = ("machine_key", "alert_type_key", "raised_at")
    assert keyed(job.alert_fact(spark), *cols) == keyed(star.alerts, *cols)
    cols = ("machine_id", "started_at", "ended_at", "duration_minutes", "reason_code", "is_open")
    assert keyed(job.downtime_fact(spark), *cols) == keyed(star.downtime, *cols)
    assert job.sensor(spark).count() == star.readings.count()
    assert job.dead_letters(spark).count() == 0

    # A restart with nothing new adds nothing.
    before = job.sensor(spark).count()
    jobs.wait_for([job.start(messages.file_stream(spark, path, 1), once=True)])
    assert job.sensor(spark).count() == before


def test_replayed_batch_changes_nothing(spark, star):
    job = jobs.StarJob(scratch_path(spark, "replay"), star.machines, star.statuses, star.alert_types, 60)
    parsed = messages.parse(messages.envelope(to_envelope(star.readings, broken=True)))
    for _ in range(2):
        job.process(parsed, 0)
    good, bad = messages.split_valid(parsed)
    assert job.sensor(spark).count() == good.count()
    assert job.dead_letters(spark).count() == bad.count()
    assert job.hourly(spark).agg(F.sum("reading_count")).first()[0] == good.count()
    stops = job.downtime_fact(spark)
    assert stops.count() == stops.select("machine_id", "started_at").distinct().count()


def test_batch_without_valid_rows_hands_state_on(spark, star):
    job = jobs.StarJob(scratch_path(spark, "carry"), star.machines, star.statuses, star.alert_types, 60)
    parsed = messages.parse(messages.envelope(to_envelope(star.readings, broken=False)))
    day = F.to_date("d.event_time")
    job.process(parsed.where(day < "2024-01-03"), 0)
    job.process(parsed.where("false"), 1)
    job.process(parsed.where(day >= "2024-01-03"), 2)
    cols = ("machine_id", "started_at", "ended_at")
    assert keyed(job.downtime_fact(spark), *cols) == keyed(star.downtime, *cols)
    cols = ("machine_key", "alert_type_key", "raised_at")
    assert keyed(job.alert_fact(spark), *cols) == keyed(star.alerts, *cols)


def test_failed_batch_is_logged_and_raised(spark, star):
    job = jobs.StarJob(scratch_path(spark, "failing"), star.machines.drop("machine_key"), star.statuses, star.alert_types)
    parsed = messages.parse(messages.envelope(to_envelope(star.readings, broken=False)))
    with pytest.raises(Exception):
        job.process(parsed, 0)
    log = spark.read.parquet(job.path("batch_log")).collect()
    assert [r.status for r in log] == ["FAILED"] and "machine_key" in log[0].error_detail


def test_first_generation_stream(spark, star):
    path, _ = daily_files(spark, star)
    raw = messages.file_stream(spark, path, 1)
    rows = messages.parse(messages.envelope(raw)).select(
        (F.col("kafka_offset") * 3 + F.col("kafka_partition")).alias("reading_id"), "d.*")
    job = jobs.FirstGenerationJob(scratch_path(spark, "first"))
    jobs.wait_for(job.start(rows, once=True))
    cols = ("machine_id", "started_at", "ended_at", "reason_code")
    want = star.downtime_events.toDF("event_id", "machine_id", "started_at", "ended_at", "duration_minutes", "reason_code")
    assert keyed(job.stops(spark), *cols) == keyed(want, *cols)
    cols = ("alert_id", "alert_type", "severity")
    assert keyed(job.alerts(spark), *cols) == keyed(star.failure_alerts, *cols)


def test_late_rows_do_not_change_a_minute(spark):
    """A row behind the watermark is left out; one within it updates its minute."""
    path = scratch_path(spark, "late")
    at = lambda s: dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    schema = "reading_id long, machine_id string, event_time timestamp, temperature_c double, power_kw double, status string, units_produced int, good_units int"
    row = lambda i, s: (i, "M-101", at(s), 50.0, 1.0, "RUNNING", 1, 1)
    batches = [[row(1, 0), row(2, 600)], [row(3, 610)], [row(4, 5), row(5, 590)]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(path)
    job = jobs.FirstGenerationJob(scratch_path(spark, "late_out"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).withColumn(
        "vibration_mm_s", F.lit(1.0))
    jobs.wait_for([job.start_minutes(stream, once=True)])
    got = {r.window_start.minute: r.reading_count for r in job.minutes(spark).collect()}
    assert got == {0: 1, 9: 1, 10: 2}  # reading 4 came ten minutes late


def test_minutes_keep_the_newest_version(spark, star):
    path = scratch_path(spark, "versions")
    kpis = production.minute_kpis(star.readings)
    sinks.write_batch(kpis.withColumn("units_produced", F.lit(-1).cast("bigint")), path, 0)
    sinks.write_batch(kpis, path, 1)
    newest = sinks.latest(spark.read.parquet(path), ["machine_id", "window_start"])
    cols = ("machine_id", "window_start", "units_produced")
    assert keyed(newest, *cols) == keyed(kpis, *cols)


def test_source_options():
    assert messages.kafka_options("k:9092", "t") == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "20000"}
    assert "maxOffsetsPerTrigger" not in messages.kafka_options("k:9092", "t", None)


def test_repeated_messages_count_once(spark, star, monkeypatch):
    """In their batch and in the next one; late rows of a new offset are kept. Folders and states do not grow with batches."""
    monkeypatch.setattr(jobs, "MAX_FOLDERS", 2)
    job = jobs.StarJob(scratch_path(spark, "repeats"), star.machines, star.statuses, star.alert_types, 60)
    parsed = messages.parse(messages.envelope(to_envelope(star.readings, broken=False)))
    day = F.dayofmonth("d.event_time")
    for batch in range(5):
        part = parsed.where(day.between(batch, batch + 1))  # every day but the first comes with two batches
        job.process(part.unionByName(part.limit(7)), batch)
    late = parsed.where(day == 6).withColumn("d", F.col("d").withField("event_time", F.col("d.event_time") - F.expr("INTERVAL 3 DAYS")))
    job.process(late, 5)
    job.process(late, 6)
    assert job.sensor(spark).count() == star.readings.count()
    assert job.sensor(spark).select("reading_id").distinct().count() == star.readings.count()
    assert job.hourly(spark).agg(F.sum("reading_count")).first()[0] == star.readings.count()
    assert all(r.folders <= 2 for name in ("sensor", "hourly_parts") for r in job.store(name).partitions().collect())
    files, where = job.store("sensor", jobs.SENSOR, "event_ts")._file("..", "offsets")
    assert len(files.listStatus(where)) <= 3
    offsets = spark.read.parquet(sinks.batch_path(job.path("offsets"), 6))
    assert offsets.count() == 3


def test_message_numbers_do_not_collide(spark):
    rows = [(t, p, o) for t in ("a", "b") for p in (0, 1, 1023, 1024, 5000) for o in (0, 1, 2, 10**9)]
    df = spark.createDataFrame(rows, "kafka_topic string, kafka_partition int, kafka_offset bigint")
    found = df.select("kafka_offset", messages.message_id(("a", "b")).alias("n")).collect()
    assert len({r.n for r in found}) == len(rows)
    assert [r.kafka_offset for r in sorted(found, key=lambda r: r.n)] == sorted(o for _, _, o in rows)
    for bad in (("c", 0, 0), ("a", 1 << 16, 0), ("a", 0, 1 << 43), ("a", None, 1)):
        with pytest.raises(Exception, match="no number for message"):
            spark.createDataFrame([bad], df.schema).select(messages.message_id(("a", "b"))).collect()


def test_field_violations_are_stored(spark, star):
    job = jobs.StarJob(scratch_path(spark, "fields"), star.machines, star.statuses, star.alert_types, 60)
    raw = to_envelope(star.readings, broken=False)
    hot = F.regexp_replace("value", '"power_kw":[^,}]*', '"power_kw":"much"')
    raw = raw.withColumn("value", F.when(F.col("offset") < 4, hot).otherwise(F.col("value")))
    job.process(messages.parse(messages.envelope(raw)), 0)
    found = job.violations(spark).collect()
    assert len(found) == raw.where("offset < 4").count() and all(r.bad_fields == ["power_kw"] for r in found)
    assert job.sensor(spark).where("power_kw IS NULL").count() == len(found)


def test_one_row_a_minute_after_many_batches(spark):
    """Ten batches that all change the same minutes."""
    path = scratch_path(spark, "ten")
    at = dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=dt.timezone.utc)
    schema = "reading_id long, machine_id string, event_time timestamp, temperature_c double, power_kw double, status string, units_produced int, good_units int, vibration_mm_s double"
    for b in range(10):
        rows = [(10 * b + i, "M-101", at + dt.timedelta(seconds=20 * i + b), 50.0, 1.0, "RUNNING", 1, 1, 1.0) for i in range(6)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    job = jobs.FirstGenerationJob(scratch_path(spark, "ten_out"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.wait_for([job.start_minutes(stream, once=True)])
    assert sorted((r.window_start.minute, r.reading_count) for r in job.minutes(spark).collect()) == [(0, 30), (1, 30)]


def test_equal_offsets_of_two_partitions_are_two_messages(spark):
    schema = "kafka_topic string, kafka_partition int, kafka_offset bigint, machine_id string, event_time timestamp"
    at = dt.datetime(2024, 1, 5)
    rows = [("t", 0, 7, "M-1", at), ("t", 1, 7, "M-1", at), ("u", 0, 7, "M-1", at)] * 2
    path, out = scratch_path(spark, "partitions"), scratch_path(spark, "partitions_out")
    spark.createDataFrame(rows, schema).write.parquet(path)
    writer = jobs.without_repeats(spark.readStream.schema(schema).parquet(path)).writeStream.option("checkpointLocation", out + "_checkpoint")
    jobs.wait_for([writer.format("parquet").option("path", out).trigger(availableNow=True).start()])
    assert keyed(spark.read.parquet(out), "kafka_topic", "kafka_partition") == [("t", 0), ("t", 1), ("u", 0)]


def test_a_batch_of_few_files_is_parsed_on_all_cores(spark, star):
    from conftest import SMALL
    from millgauge.catalog import envelope
    from millgauge.catalog.registry import Context

    path, seen = scratch_path(spark, "two_files"), []
    star.readings.repartition(envelope.FEED_FILES).write.parquet(path)
    rows = envelope.feed_stream(Context(spark, SMALL), path)
    writer = rows.writeStream.foreachBatch(lambda batch, _: seen.append((batch.rdd.getNumPartitions(), batch.count())))
    jobs.wait_for([writer.option("checkpointLocation", path + "_checkpoint").trigger(availableNow=True).start()])
    assert seen == [(spark.sparkContext.defaultParallelism, star.readings.count())] and seen[0][0] > envelope.FEED_FILES


def test_only_rows_with_a_null_field_are_parsed_again(spark):
    text = '{"machine_id": "M-1", "event_time": "2024-01-05T10:00:00.000000Z", "temperature_c": "hot"}'
    raw = spark.createDataFrame([("t", 0, 1, dt.datetime(2024, 1, 5), text)],
                                "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, raw_payload string")
    found = messages.field_violations(messages.parse(raw))
    assert found.first().bad_fields == ["temperature_c"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(d" in plan and plan.index("isnull(d") < plan.index("map<string,string>" if "map<string,string>" in plan else "MapType")


def test_a_feed_is_written_once_and_read_in_order(spark, star, monkeypatch):
    from millgauge.catalog import envelope

    class Source:
        readings = star.readings.where("event_time < '2024-01-03' OR event_time >= '2024-01-05'")  # days without a row keep their files

    Source.spark = spark
    monkeypatch.setattr(envelope, "FEED_DAYS", 1)
    path, seen = scratch_path(spark, "feed"), []
    chunks = envelope.write_feed(Source, path)
    rows = envelope.feed_stream(Source, path)
    writer = rows.writeStream.foreachBatch(lambda batch, k: seen.append((k, [str(r[0]) for r in batch.select(F.to_date("event_time")).distinct().collect()])))
    jobs.wait_for([jobs.started(writer.option("checkpointLocation", path + "_checkpoint").trigger(availableNow=True), spark)])
    days = ["2024-01-01", "2024-01-02", None, None, "2024-01-05", "2024-01-06"]
    assert chunks == 6 and seen == [(k, [d] if d else []) for k, d in enumerate(days)]
    assert [envelope.files_per_batch(n) for n in (0, 4, 16, 17, 1350)] == [2, 2, 2, 4, 170]


def test_state_has_a_partition_for_each_core(spark, star):
    name = "spark.sql.shuffle.partitions"
    path, before = scratch_path(spark, "few"), spark.conf.get(name)
    star.readings.write.parquet(path)
    spark.conf.set(name, "50")
    try:
        job = jobs.FirstGenerationJob(scratch_path(spark, "few_job"))
        q = job.start_minutes(spark.readStream.schema(star.readings.schema).parquet(path), once=True)
        jobs.wait_for([q])
        assert spark.conf.get(name) == "50"
        assert {s["numShufflePartitions"] for p in q.recentProgress for s in p["stateOperators"]} == {spark.sparkContext.defaultParallelism}
    finally:
        spark.conf.set(name, before)
