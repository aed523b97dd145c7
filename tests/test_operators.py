"""Merges, history, scoping, gates and alerts on small hand-written rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millgauge.functions.numeric import percent, ratio
from millgauge.functions.text import mask_email, month_of_partition
from millgauge.operators import alerts, dimensions, merge, scd2, security
from millgauge.operators.downtime import as_open, close_episodes
from millgauge.operators.joins import as_of_version
from millgauge.plans import gates, health, timeintel
from millgauge.plans.migration import planned_reason
from millgauge.session import scratch_path
from millgauge.sources import jdbc, seeds, sinks

UTC = dt.timezone.utc
T = lambda h, m=0, d=1: dt.datetime(2024, 1, d, h, m, tzinfo=UTC)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- merges -------------------------------------------------------------------
@pytest.fixture
def old(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")


@pytest.fixture
def new(spark):
    return spark.createDataFrame([(2, "B", 21), (3, "c", None)], "k int, v string, n int")


def test_insert_ignore(old, new):
    out = merge.insert_ignore(old, new, ["k"])
    assert tuples(out) == [(1, "a", 10), (2, "b", 20), (3, "c", None)]
    assert tuples(merge.insert_ignore(out, new, ["k"])) == tuples(out)


def test_upsert(old, new):
    out = merge.upsert(old, new, ["k"])
    assert tuples(out) == [(1, "a", 10), (2, "B", 21), (3, "c", None)]
    assert tuples(merge.upsert(out, new, ["k"])) == tuples(out)


def test_update_columns_keeps_guarded_rows(old, new):
    assert tuples(merge.update_columns(old, new, ["k"], ["n"], F.col("n") > 100)) == tuples(old)
    assert tuples(merge.update_columns(old, new, ["k"], ["n"])) == [(1, "a", 10), (2, "b", 21)]


def test_drop_orphans_and_grain(old, new):
    assert tuples(merge.drop_orphans(old, new, ["k"])) == [(2, "b", 20)]
    assert merge.grain_violations(old.unionByName(new), ["k"]).first().k == 2


def test_guarded_close_ignores_closed_stops(spark):
    opened = spark.createDataFrame([("a", T(1)), ("b", T(2))], "machine_id string, started_at timestamp")
    ends = spark.createDataFrame([("a", T(1), T(1, 30))], "machine_id string, started_at timestamp, ended_at timestamp")
    once = close_episodes(as_open(opened), ends)
    later = spark.createDataFrame([("a", T(1), T(9))], "machine_id string, started_at timestamp, ended_at timestamp")
    twice = close_episodes(once, later)
    got = {r.machine_id: (r.duration_minutes, r.is_open) for r in twice.collect()}
    assert got == {"a": (30.0, False), "b": (None, True)}


def test_retention_names(spark):
    names = spark.createDataFrame([("f_202305",), ("f_2023_06",), ("f_202401",), ("f_default",)], "p string")
    assert tuples(merge.expired_partitions(names, "p", F.lit("2024-02-10").cast("date"), 6)) == [("f_202305",), ("f_2023_06",)]
    assert names.select(month_of_partition(F.col("p"))).collect()[3][0] is None


# ---- history -------------------------------------------------------------------
def test_history_and_as_of(spark):
    first = dimensions.load_machines(seeds.machine_master(spark))
    moved = first.where("machine_key > 0").withColumn(
        "production_line", F.when(F.col("machine_id") == "M-104", "LINE-A").otherwise(F.col("production_line")))
    at = F.lit("2024-01-16").cast("timestamp")
    once = scd2.apply_versions(first, moved, at)
    twice = scd2.apply_versions(once, moved, at)
    assert once.count() == first.count() + 1 and tuples(once) == tuples(twice)
    assert once.where("is_current").groupBy("machine_id").count().where("count > 1").count() == 0
    facts = spark.createDataFrame([(1, "M-104", T(0, 0, 15)), (2, "M-104", T(0, 0, 16)), (3, "M-999", T(1)),
                                   (4, "M-104", dt.datetime(1960, 1, 1, tzinfo=UTC))], "i int, machine_id string, ts timestamp")
    dim = twice.select("machine_id", "production_line", "valid_from", "valid_to")
    got = {r.i: r.production_line for r in as_of_version(facts, dim, "machine_id", "ts").collect()}
    assert got == {1: "LINE-B", 2: "LINE-A", 3: None, 4: "LINE-B"}


def test_row_hash_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(scd2.row_hash(["x", "y"])).distinct().count() == 2


# ---- scoping -------------------------------------------------------------------
@pytest.mark.parametrize("user,members", [("EXEC@contoso.com", 6), ("plant.mgr@contoso.com", 6), ("linea.sup@contoso.com", 4),
                                          ("lineb.sup@contoso.com", 3), ("old.sup@contoso.com", 1), ("nobody@x", 1), (None, 1)])
def test_access_tiers(spark, user, members):
    dim, scopes = dimensions.load_machines(seeds.machine_master(spark)), seeds.user_scopes(spark)
    assert security.scoped_machines(dim, scopes, user).count() == members
    facts = dim.select("machine_key")
    # Only a scope without plant covers the Unknown member of the facts.
    expected = members if user == "EXEC@contoso.com" else members - 1
    assert security.scoped_fact(facts, dim, scopes, user).count() == expected


def test_mask(spark):
    df = spark.createDataFrame([("bob@x.com",), (None,)], "m string")
    assert [r[0] for r in df.select(mask_email(F.col("m"))).collect()] == ["b***@x.com", ""]
    assert [r[0] for r in df.select(mask_email(F.col("m"), True)).collect()] == ["bob@x.com", None]


# ---- gates and health -------------------------------------------------------------
def test_freshness_bands(spark):
    as_of = F.lit("2024-01-01 12:00:00").cast("timestamp")
    rows = lambda *t: spark.createDataFrame([(x,) for x in t], "event_ts timestamp")
    status = lambda df: health.freshness(df, as_of).first()
    assert status(rows(T(11, 59))).status == "HEALTHY"
    assert status(rows(T(11, 55))).status == "DEGRADED"
    assert status(rows(T(10))).status == "STALLED"
    empty = status(rows())
    assert empty.status == "NO DATA" and empty.lag_seconds is None
    assert not gates.fresh_enough(health.freshness(rows(), as_of)).passed
    assert gates.fresh_enough(health.freshness(rows(T(11, 55)), as_of)).passed


def test_converge_publishes_only_when_all_pass():
    good = lambda: gates.GateResult("a", True, "")
    bad = lambda: gates.GateResult("b", False, "late")
    done = []
    assert len(gates.converge([good, good], lambda: done.append(1))) == 2
    with pytest.raises(gates.GateFailed, match="b: late"):
        gates.converge([good, bad], lambda: done.append(2))
    assert done == [1]


def test_lineage_survives_quotes(spark):
    path = scratch_path(spark, "log")

    def fail():
        raise RuntimeError("can't read 'x' " + "y" * 3000)

    with pytest.raises(RuntimeError):
        sinks.run_logged(spark, path, "job", "1", fail)
    row = sinks.run_outcomes(spark.read.parquet(path)).first()
    assert row.status == "FAILED" and row.error_detail.startswith("can't read 'x'") and len(row.error_detail) > 3000


def test_null_safe_arithmetic(spark):
    row = spark.sql("SELECT 1 AS a, 0 AS b").select(ratio("a", "b"), percent("a", "b")).first()
    assert row[0] is None and row[1] is None


def test_planned_reason(spark):
    df = spark.createDataFrame([("Unplanned stop",), ("Planned stop",), ("line MAINTENANCE",), (None,), ("jam",)], "r string")
    assert [r[0] for r in df.select(planned_reason(F.col("r"))).collect()] == [False, True, True, False, False]
    assert df.select(planned_reason(F.col("r"), legacy=True)).first()[0] is True


def test_jdbc_contract():
    opts = jdbc.options("jdbc:postgresql://db/iot", "u", "p")
    assert opts["tcpKeepAlive"] == "true" and opts["reWriteBatchedInserts"] == "true"
    assert int(opts["connectTimeout"]) > 0 and int(opts["socketTimeout"]) > 0


# ---- alerts -------------------------------------------------------------------
def test_emit_batch_suppresses_within_rearm(spark, star):
    raised = alerts.emit_batch(star.conformed, star.alert_types, star.alerts.where("false"))
    first = raised.orderBy("raised_at").first()
    recent = spark.createDataFrame([(first.machine_key, first.alert_type_key, first.raised_at - dt.timedelta(minutes=3))],
                                   "machine_key long, alert_type_key int, raised_at timestamp")
    older = recent.withColumn("raised_at", F.col("raised_at") - F.expr("INTERVAL 5 MINUTES"))
    assert alerts.emit_batch(star.conformed, star.alert_types, recent).count() == raised.count() - 1
    assert alerts.emit_batch(star.conformed, star.alert_types, older).count() == raised.count()


def test_exclusive_and_independent_rules_differ(spark):
    rows = spark.createDataFrame([(1, "M-101", T(1), 85.0, 5.0, "RUNNING"), (2, "M-101", T(2), 90.0, 6.0, "FAULT")],
                                 "reading_id long, machine_id string, event_time timestamp, temperature_c double, vibration_mm_s double, status string")
    assert [r.alert_type for r in alerts.exclusive_alerts(rows).orderBy("alert_id").collect()] == ["HIGH_TEMP", "FAULT_STATUS"]
    got = {(r.reading_id, r.alert_code) for r in alerts.candidates(rows).collect()}
    assert got == {(1, "HIGH_VIBRATION"), (2, "FAULT_STATUS"), (2, "HIGH_TEMP"), (2, "HIGH_VIBRATION")}


# ---- time intelligence ------------------------------------------------------------
def test_month_gap_has_no_predecessor(spark):
    months = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 3, 1), 3.0), (dt.date(2024, 4, 1), 4.0)],
                                   "month_start date, v double")
    got = {r.month_start.month: r.p for r in timeintel.previous_month(months, "v", "p").collect()}
    assert got == {1: None, 3: None, 4: 3.0}


def test_rolling_counts_days_not_rows(spark):
    rng = random.Random(3)
    days = sorted(rng.sample(range(120), 60))
    base = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(d), d) for d in days], "day date, c_units int")
    got = {r.day: r.c_units for r in timeintel.rolling(df, "day", 7, parts=["c_units"]).collect()}
    assert got == {base + dt.timedelta(d): sum(x for x in days if d - 6 <= x <= d) for d in days}
