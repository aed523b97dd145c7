"""Rule checks, scaffolds and run lengths over facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.text import row_json
from ..sources.sinks import run_outcomes
from .dimensions import date_span
from .joins import hour_scaffold, small
from .sequence import run_lengths


def violations(df: DataFrame, source: str, rules: dict[str, Column], key: str, detail: Sequence[str]) -> DataFrame:
    """One exception row per broken rule. All rules are checked in one pass."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select(
        F.lit(source).alias("source_table"),
        F.explode(hits).alias("rule_name"),
        F.col(key).cast("string").alias("record_key"),
        row_json(*detail).alias("detail"),
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def hourly_counts(fact: DataFrame, ts: str) -> DataFrame:
    return fact.groupBy(F.to_date(ts).alias("full_date"), F.hour(ts).alias("hour_24")).agg(
        F.count("*").alias("readings")
    )


def scaffold_counts(fact: DataFrame, ts: str, dates: DataFrame | None = None) -> DataFrame:
    """Readings per date and hour with zero rows for silent hours. Facts are counted
    before they meet the scaffold, so the join is hours against hours."""
    counts = hourly_counts(fact, ts)
    days = dates if dates is not None else date_span(fact.select(F.to_date(ts).alias("d")), "d")
    return hour_scaffold(days).join(counts, ["full_date", "hour_24"], "left").select(
        "full_date", "hour_24", F.coalesce("readings", F.lit(0)).alias("readings")
    )


def silent_hours(fact: DataFrame, ts: str, members: DataFrame, key: str) -> DataFrame:
    """Hours without a reading, of every member. The scaffold is members by days by hours: what is asked for, whatever the facts hold."""
    counts = fact.groupBy(F.col(key).alias("_of"), F.to_date(ts).alias("_date"), F.hour(ts).alias("_hour")).agg(F.count("*").alias("readings"))
    span = date_span(fact.select(F.to_date(ts).alias("d")), "d")
    every = hour_scaffold(span).crossJoin(small(members.select(key)))
    met = (F.col(key) == F.col("_of")) & (F.col("full_date") == F.col("_date")) & (F.col("hour_24") == F.col("_hour"))
    return every.join(counts, met, "left_anti").select(key, "full_date", "hour_24", F.lit(0).cast("bigint").alias("readings"))


def completeness(fact: DataFrame, ts: str, expected_per_hour: int) -> DataFrame:
    """Actual against expected readings per day; the target is 99.9 %."""
    daily = scaffold_counts(fact, ts).groupBy("full_date").agg(
        F.sum("readings").alias("readings"), (F.count("*") * expected_per_hour).alias("expected")
    )
    pct = percent("readings", "expected", 4)
    return daily.withColumn("completeness_pct", pct).withColumn(
        "status", F.when(pct > 99.9, "OK").otherwise("BELOW TARGET")
    )


def busy_minutes(alerts: DataFrame, ts: str, limit: int = 100) -> DataFrame:
    """Minutes with more alerts than the limit."""
    return alerts.groupBy(F.date_trunc("minute", ts).alias("minute")).agg(F.count("*").alias("alerts")).where(
        F.col("alerts") > limit
    )


def failure_runs(log: DataFrame, length: int = 3) -> DataFrame:
    """Batches at which the last ``length`` finished runs of their job have all failed."""
    runs = run_outcomes(log).where("status <> 'RUNNING'").select(*log.columns)
    counted = run_lengths(runs, ["job_name"], "started_at", ["batch_id"], F.col("status") == "FAILED", "_run", chunk_seconds=86400)
    return counted.where(F.col("_run") >= length).select(*log.columns)


def aggregate_matches(hourly: DataFrame, sensor: DataFrame) -> DataFrame:
    """Hourly sums against atomic sums by machine and date, with a verdict per cell."""
    a = hourly.groupBy("machine_key", "date_key").agg(
        F.sum("units_produced").cast("bigint").alias("units_hourly"),
        F.sum("good_units").cast("bigint").alias("good_hourly"),
        F.sum("reading_count").alias("readings_hourly"),
        F.sum("temp_sum").alias("_ta"),
    )
    b = sensor.groupBy("machine_key", "date_key").agg(
        F.sum("units_produced").cast("bigint").alias("units_atomic"),
        F.sum("good_units").cast("bigint").alias("good_atomic"),
        F.count("*").alias("readings_atomic"),
        F.sum("temperature_c").alias("_tb"),
    )
    same = (
        F.col("units_hourly").eqNullSafe(F.col("units_atomic"))
        & F.col("good_hourly").eqNullSafe(F.col("good_atomic"))
        & F.col("readings_hourly").eqNullSafe(F.col("readings_atomic"))
        & F.col("_ta").eqNullSafe(F.col("_tb"))
    )
    return a.join(b, ["machine_key", "date_key"], "full").withColumn(
        "verdict", F.when(same, "MATCH").otherwise("MISMATCH")
    ).drop("_ta", "_tb")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    return out
