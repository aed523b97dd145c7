"""Dimension builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, keys
from ..functions.text import contains
from ..schemas import FIRST_START, OPEN_END
from ..sources import seeds

PLANT = "PLANT-01"
CRITICAL_TYPES = ("CNC", "PRESS")
LINES = ("A", "B", "C")


def dim_date(spark: SparkSession, start: str = "2024-01-01", end: str = "2034-12-31") -> DataFrame:
    days = spark.sql(
        f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS full_date"
    )
    return dates_of(days)


def dates_of(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``full_date`` column."""
    return days.select(*[c.alias(n) for n, c in calendar.calendar(F.col("full_date")).items()])


def date_span(facts: DataFrame, date: str) -> DataFrame:
    """Gap-free ``full_date`` axis over the dates that occur in a fact."""
    ends = facts.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return ends.select(F.explode(F.expr("sequence(lo, hi, INTERVAL 1 DAY)")).alias("full_date"))


def dim_time(spark: SparkSession) -> DataFrame:
    minute = F.col("id").cast("int")
    return spark.range(1440).select(*[c.alias(n) for n, c in calendar.clock(minute).items()])


def production_line(location: Column, machine_id: Column) -> Column:
    """Line named in the location; else the last digit of the id decides."""
    named = F.coalesce(
        *[F.when(contains(location, f"line {x}", f"line-{x}"), f"LINE-{x}") for x in LINES]
    )
    digit = F.right(machine_id, F.lit(1)).try_cast("int")
    return F.coalesce(named, F.when(digit <= 3, "LINE-A").otherwise("LINE-B"))


def criticality(machine_type: Column) -> Column:
    return F.when(F.upper(machine_type).isin(*CRITICAL_TYPES), "HIGH").otherwise("MEDIUM")


def machine_rows(master: DataFrame) -> DataFrame:
    """Master data with derived line, plant, criticality and first-version validity."""
    start = F.lit(FIRST_START).cast("timestamp")
    return master.select(
        version_key(F.col("machine_id"), start).alias("machine_key"),
        "machine_id", "machine_name", "machine_type", "location",
        production_line(F.col("location"), F.col("machine_id")).alias("production_line"),
        F.lit(PLANT).alias("plant_code"),
        "installed_date", "ideal_cycle_time_sec", "manufacturer", "rated_power_kw",
        criticality(F.col("machine_type")).alias("criticality"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.lit(False).alias("is_inferred"),
        start.alias("valid_from"),
        F.lit(OPEN_END).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def version_key(machine_id: Column, valid_from: Column) -> Column:
    return keys.hashed_key(machine_id, F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss"))


def load_machines(master: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Only natural keys without a current row are added."""
    new = machine_rows(master)
    if existing is None:
        return new.unionByName(seeds.unknown_machine(master.sparkSession))
    current = existing.where("is_current").select("machine_id")
    return existing.unionByName(new.join(current, "machine_id", "left_anti").select(*existing.columns))


def infer_machines(dim: DataFrame, facts: DataFrame) -> DataFrame:
    """Members seen in facts but absent from master data, marked as inferred."""
    known = dim.where("is_current").select("machine_id")
    missing = facts.select("machine_id").where("machine_id IS NOT NULL").distinct().join(
        known, "machine_id", "left_anti"
    )
    start = F.lit(FIRST_START).cast("timestamp")
    rows = missing.select(
        version_key(F.col("machine_id"), start).alias("machine_key"),
        "machine_id",
        F.col("machine_id").alias("machine_name"),
        F.lit("UNKNOWN").alias("machine_type"),
        F.lit(None).cast("string").alias("location"),
        F.lit("UNASSIGNED").alias("production_line"),
        F.lit(PLANT).alias("plant_code"),
        F.lit(None).cast("date").alias("installed_date"),
        F.lit(1).cast("decimal(10,2)").alias("ideal_cycle_time_sec"),
        F.lit(None).cast("string").alias("manufacturer"),
        F.lit(None).cast("decimal(10,2)").alias("rated_power_kw"),
        F.lit("MEDIUM").alias("criticality"),
        F.lit(True).alias("is_active"),
        F.lit(True).alias("is_inferred"),
        start.alias("valid_from"),
        F.lit(OPEN_END).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return dim.unionByName(rows)


def planned_time(machines: DataFrame, dates: DataFrame, minutes: int = 480) -> DataFrame:
    """Every machine on every date. The product is the feature: machines × days."""
    return machines.select("machine_id").crossJoin(dates.select("full_date")).select(
        "machine_id", F.col("full_date").alias("production_date"), F.lit(minutes).alias("planned_minutes")
    )
