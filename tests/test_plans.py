"""Physical plans: what reaches the scan, what is broadcast, what is shuffled."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from millgauge.operators.joins import estimated_bytes, small
from millgauge.plans.measures import measures
from millgauge.session import scratch_path
from millgauge.sources import seeds, sinks, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_are_broadcast_and_facts_shuffle_once(star):
    text = plan(star.hourly)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1  # the aggregate, after map-side sums
    assert text.count("HashAggregate") == 2


def test_scan_reads_only_needed_columns(star):
    text = plan(star.readings.select("machine_id", "status").groupBy("machine_id").count())
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_filter_reaches_the_scan(spark):
    rows = tables.table(spark, SMALL, "events").where("ts >= '2024-01-20'").select("event_id")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(rows)


def test_month_bounds_reach_the_partition_filter(spark, star):
    path = scratch_path(spark, "by_month")
    sinks.write_monthly(star.sensor, path, "event_ts")
    rows = tables.read_months(spark, path, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9))
    text = plan(rows)
    assert "PartitionFilters: [isnotnull(event_month" in text and "GreaterThanOrEqual(event_ts" in text
    assert rows.count() == star.sensor.where("event_ts >= '2024-01-03' AND event_ts < '2024-01-09'").count()


def test_large_sides_are_not_broadcast(spark):
    facts = spark.range(100).withColumn("k", F.col("id") % 5)
    dim = spark.range(5).withColumnRenamed("id", "k")
    assert estimated_bytes(seeds.statuses(spark)) < 10_000
    assert "ResolvedHint" in small(dim)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in small(dim, limit=1)._jdf.queryExecution().analyzed().toString()
    assert facts.join(small(dim, limit=1), "k").count() == 100


@pytest.mark.parametrize("names,tables_read", [(("oee", "quality"), 1), (("mtbf_hours",), 3)])
def test_measures_read_only_the_facts_they_need(star, names, tables_read):
    assert plan(measures(star, names, ("machine_id",))).count("FileScan") == tables_read


def test_newest_row_is_an_aggregate_not_a_window(star):
    from millgauge.plans.kpis import live_status

    text = plan(live_status(star.readings, star.master))
    assert "Window" not in text and "partial_max_by" in text.replace("max_by(", "partial_max_by(")


def test_no_python_workers_in_any_plan(spark):
    import __spark_entry__ as entry

    for name in ("ag1", "wn5", "st15_batch", "kpi7", "m36", "mig7"):
        text = plan(entry.queries()[name](spark, SMALL))
        assert "Python" not in text and "Pandas" not in text


def scans(df):
    return plan(df).count("FileScan")


@pytest.mark.parametrize("name,facts", [
    ("mig6", 8), ("dq6", 4), ("dq14", 4), ("rpt1", 2), ("m36", 2), ("m26_m27", 2), ("kpi2", 2), ("wn6", 2), ("mig7", 2), ("dq18_runs", 2), ("rpt15", 3),
    ("snw4", 4), ("snw5", 4), ("rls2", 1)])
def test_each_stored_fact_is_read_once(spark, name, facts):
    """The copy's two facts are read once on either side; a chain of ordered steps reads its input twice."""
    import __spark_entry__ as entry

    assert scans(entry.queries()[name](spark, SMALL)) <= facts


def test_look_back_reaches_the_scan(spark):
    import __spark_entry__ as entry

    for name in ("kpi2", "kpi7"):
        assert "GreaterThanOrEqual(event_time" in plan(entry.queries()[name](spark, SMALL))
