"""Rows that earlier versions got wrong: late rows, repeated log rows, lost state, long texts."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from millgauge.operators import downtime, quality, scd2
from millgauge.plans import health, migration
from millgauge.session import scratch_path
from millgauge.sources import messages, sinks
from millgauge.streaming import jobs, state

DAY = dt.datetime(2024, 1, 5)


def at(hour, minute=0):
    return DAY + dt.timedelta(hours=hour, minutes=minute)


def test_dead_letters_keep_the_whole_message(spark):
    text = "x" * 10_000
    raw = spark.createDataFrame([("t", 0, 1, at(1), text)],
                                "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, raw_payload string")
    _, bad = messages.split_valid(messages.parse(raw))
    assert messages.dead_letters(bad, 0).first().raw_payload == text


def test_lost_state_is_an_error(spark):
    path = scratch_path(spark, "state")
    assert state.state_before(spark, path, state.OPEN_STOPS, 0).count() == 0
    with pytest.raises(AnalysisException):
        state.state_before(spark, path, state.OPEN_STOPS, 7)
    state.save_state(spark.createDataFrame([("M-1", at(1))], state.OPEN_STOPS), path, 6)
    assert state.state_before(spark, path, state.OPEN_STOPS, 7).count() == 1


def readings(spark, rows):
    return spark.createDataFrame([(i, m, t, s) for i, (m, t, s) in enumerate(rows)],
                                 "reading_id bigint, machine_id string, event_time timestamp, status string")


def test_late_row_does_not_close_a_stop(spark):
    before = spark.createDataFrame([("M-1", at(10))], state.OPEN_STOPS)
    batch = readings(spark, [("M-1", at(9, 58), "RUNNING"), ("M-1", at(10, 1), "FAULT"), ("M-1", at(10, 5), "RUNNING")])
    opened, closed = downtime.status_changes(batch, before)
    assert opened.count() == 0
    assert [(r.started_at, r.ended_at) for r in closed.collect()] == [(at(10), at(10, 5))]


def log_rows(spark, rows):
    return spark.createDataFrame(rows, "job_name string, batch_id string, started_at timestamp, completed_at timestamp, rows_written bigint, status string")


def test_runs_count_once(spark):
    rows = []
    for k in range(4):
        rows += [("j", str(k), at(k), None, None, "RUNNING"), ("j", str(k), at(k), at(k, 5), 7, "SUCCESS")]
    rows.append(rows[-1])
    row = health.batch_health(log_rows(spark, rows), F.lit(at(6))).first()
    assert (row.batches_24h, row.success_rate_pct, row.status) == (4, 100.0, "HEALTHY")
    failed = [(j, b, s, e, n, "FAILED" if status == "SUCCESS" else status) for j, b, s, e, n, status in rows]
    assert quality.failure_runs(log_rows(spark, failed), 3).count() == 2


def test_top_reason_is_of_waiting_letters(spark):
    rows = [("a", at(1), at(2)), ("a", at(1), at(2)), ("b", at(1), None)]
    letters = spark.createDataFrame(rows, "failure_reason string, quarantined_at timestamp, replayed_at timestamp")
    assert health.dead_letter_health(letters, F.lit(at(3))).first().top_reason == "b"


MEMBER = "machine_key bigint, machine_id string, machine_name string, machine_type string, valid_from timestamp, valid_to timestamp, is_current boolean"
OPEN = dt.datetime(9999, 12, 31)
TRACKED = ("machine_name", "machine_type")


def test_history_tells_similar_values_apart(spark):
    dim = spark.createDataFrame([(1, "M", "a|b", "c", at(1), OPEN, True)], MEMBER)
    new = spark.createDataFrame([(0, "M", "a", "b|c", at(1), OPEN, True)] * 2, MEMBER)
    got = scd2.apply_versions(dim, new, F.lit(at(5)), TRACKED).collect()
    assert len(got) == 2 and sum(r.is_current for r in got) == 1


def test_backdated_change_is_refused(spark):
    dim = spark.createDataFrame([(1, "M", "a", "b", at(6), OPEN, True)], MEMBER)
    new = dim.withColumn("machine_name", F.lit("z"))
    with pytest.raises(PySparkException, match="before the current version"):
        scd2.apply_versions(dim, new, F.lit(at(5)), TRACKED).collect()


class FakeQuery:
    def __init__(self, rounds, error=None):
        self.rounds, self.error = rounds, error

    def awaitTermination(self, seconds=None):  # noqa: N802
        self.rounds -= 1
        if self.rounds <= 0 and self.error:
            raise self.error
        return self.rounds <= 0


def test_failure_of_a_later_query_surfaces():
    with pytest.raises(RuntimeError):
        jobs.wait_for([FakeQuery(10**9), FakeQuery(2, RuntimeError("second"))])
    jobs.wait_for([FakeQuery(3), FakeQuery(1)])


def test_error_text_is_logged_whole(spark):
    path = scratch_path(spark, "log")
    sinks.log_batch(spark, path, "j", "1", at(1), "FAILED", error="e" * 5000)
    assert len(spark.read.parquet(path).first().error_detail) == 5000


def test_long_stop_is_not_split_by_a_short_one_inside(spark):
    rows = [(1, "M", at(1), at(5)), (2, "M", at(2), at(2, 5)), (3, "M", at(4), at(4, 30)), (4, "M", at(9), None)]
    events = spark.createDataFrame(rows, "event_id bigint, machine_id string, start_time timestamp, end_time timestamp")
    got = sorted((r.started_at, r.ended_at, r.raw_events) for r in migration.consolidate(events).collect())
    assert got == [(at(1), at(5), 3), (at(9), at(9), 1)]
