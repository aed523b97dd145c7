"""The normalised copy of the star: build, refresh, staleness, equivalence."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hashed_key
from ..functions.numeric import differs, num
from ..operators.joins import lookup

HOURLY_KEYS = ("machine_key", "window_start")
ALERT_KEYS = ("machine_key", "alert_type_key", "raised_at")
HOURLY_COLUMNS = (
    "machine_key", "window_start", "window_end", "date_key", "shift_key", "reading_count", "units_produced",
    "good_units", "scrap_units", "runtime_minutes", "idle_minutes", "downtime_minutes", "planned_minutes",
    "energy_kwh", "avg_temperature_c", "max_temperature_c", "temp_sum", "kw_seconds", "runtime_seconds",
)
ALERT_COLUMNS = ("machine_key", "alert_type_key", "raised_at", "date_key", "shift_key", "resolved_at", "alert_count")


class Snowflake:
    """Normalised dimensions out of the denormalised ones."""

    def __init__(self, machines: DataFrame, alert_types: DataFrame) -> None:
        self.star_machines = machines
        self.star_alert_types = alert_types
        self.current = machines.where("is_current")

    @cached_property
    def manufacturers(self) -> DataFrame:
        name = F.coalesce("manufacturer", F.lit("UNKNOWN"))
        return self.current.select(name.alias("manufacturer_name")).distinct().select(
            hashed_key(F.col("manufacturer_name")).alias("manufacturer_key"), "manufacturer_name",
            F.lit("UNKNOWN").alias("country"), F.lit("STANDARD").alias("support_tier"),
        )

    @cached_property
    def plants(self) -> DataFrame:
        return self.current.select("plant_code").distinct().select(
            hashed_key(F.col("plant_code")).alias("plant_key"), "plant_code",
            F.col("plant_code").alias("plant_name"), F.lit("UNKNOWN").alias("region"), F.lit("UTC").alias("timezone"),
        )

    @cached_property
    def alert_categories(self) -> DataFrame:
        return self.star_alert_types.select("alert_category").distinct().select(
            hashed_key(F.col("alert_category")).alias("alert_category_key"),
            F.col("alert_category").alias("alert_category_code"),
            F.lit("MAINTENANCE").alias("owning_team"),
        )

    @cached_property
    def severities(self) -> DataFrame:
        return self.star_alert_types.groupBy(F.col("severity").alias("severity_code")).agg(
            F.min("severity_rank").alias("severity_rank")
        ).select(
            hashed_key(F.col("severity_code")).alias("severity_key"), "severity_code", "severity_rank",
            F.lit("SHIFT_SUPERVISOR").alias("escalation_path"),
        )

    @cached_property
    def machine_types(self) -> DataFrame:
        """One row per type; where members disagree the critical class and the first maker win."""
        maker = F.coalesce("manufacturer", F.lit("UNKNOWN"))
        return self.current.groupBy(F.col("machine_type").alias("machine_type_code")).agg(
            F.min(maker).alias("_maker"), F.max(F.col("criticality") == "HIGH").alias("_critical")
        ).select(
            hashed_key(F.col("machine_type_code")).alias("machine_type_key"), "machine_type_code",
            hashed_key(F.col("_maker")).alias("manufacturer_key"),
            F.when(F.col("_critical"), "CRITICAL_ASSET").otherwise("STANDARD_ASSET").alias("asset_class"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        rows = self.current.select("production_line", "plant_code").distinct()
        rows = lookup(rows, self.plants.select("plant_code", "plant_key"), "plant_code", "inner")
        return rows.select(
            hashed_key(F.col("production_line"), F.col("plant_code")).alias("production_line_key"),
            F.col("production_line").alias("production_line_code"),
            "plant_key", F.lit("UNASSIGNED").alias("line_supervisor"),
        )

    @cached_property
    def machines(self) -> DataFrame:
        rows = lookup(self.star_machines, self.machine_types.select(
            F.col("machine_type_code").alias("machine_type"), "machine_type_key"), "machine_type")
        rows = lookup(rows, self.plants.select("plant_code", "plant_key"), "plant_code")
        rows = lookup(rows, self.lines.select(
            F.col("production_line_code").alias("production_line"), "plant_key", "production_line_key"),
            ["production_line", "plant_key"])
        return rows.select("machine_key", "machine_id", "machine_name", "machine_type_key", "production_line_key",
                           "installed_date", "ideal_cycle_time_sec", "criticality", "valid_from", "valid_to",
                           "is_current")

    @cached_property
    def alert_types(self) -> DataFrame:
        rows = lookup(self.star_alert_types, self.alert_categories.select(
            F.col("alert_category_code").alias("alert_category"), "alert_category_key"), "alert_category")
        rows = lookup(rows, self.severities.select(
            F.col("severity_code").alias("severity"), "severity_key"), "severity")
        return rows.select("alert_type_key", "alert_code", "alert_name", "alert_category_key", "severity_key",
                           "sla_response_minutes")

    # ---- facts joined through the chains ----
    def production_chain(self, hourly: DataFrame) -> DataFrame:
        m = self.machines.select("machine_key", "machine_type_key", "production_line_key")
        out = lookup(hourly, m, "machine_key", "inner")
        out = lookup(out, self.machine_types.select("machine_type_key", "machine_type_code"), "machine_type_key", "inner")
        return lookup(out, self.lines.select("production_line_key", "production_line_code", "plant_key"),
                      "production_line_key", "inner")

    def plant_chain(self, hourly: DataFrame) -> DataFrame:
        m = self.machines.select("machine_key", "production_line_key")
        out = lookup(hourly, m, "machine_key", "inner")
        out = lookup(out, self.lines.select("production_line_key", "plant_key"), "production_line_key", "inner")
        return lookup(out, self.plants.select("plant_key", "plant_code"), "plant_key", "inner")

    def alert_chain(self, alerts: DataFrame) -> DataFrame:
        a = self.alert_types.select("alert_type_key", "severity_key", "alert_category_key")
        out = lookup(alerts, a, "alert_type_key", "inner")
        out = lookup(out, self.severities.select("severity_key", "severity_code"), "severity_key", "inner")
        return lookup(out, self.alert_categories.select("alert_category_key", "alert_category_code", "owning_team"),
                      "alert_category_key", "inner")


# ---- the three comparison questions, either chain -----------------------------
def production_by_type_and_line(rows: DataFrame, machine_type: str, line: str) -> DataFrame:
    return rows.groupBy(F.col(machine_type).alias("machine_type"), F.col(line).alias("production_line")).agg(
        F.sum("units_produced").cast("bigint").alias("units"),
        F.sum("good_units").cast("bigint").alias("good"),
        (num(F.sum("runtime_seconds")) / 60).alias("runtime_min"),
    )


def alerts_by_severity(rows: DataFrame, *group: str) -> DataFrame:
    return rows.groupBy(*group).agg(F.sum("alert_count").alias("alerts"))


def energy_by_plant(rows: DataFrame) -> DataFrame:
    return rows.groupBy("plant_code").agg(
        (num(F.sum("kw_seconds")) / 3600).alias("kwh"),
        F.sum("units_produced").cast("bigint").alias("units"),
    )


# ---- refresh and checks -------------------------------------------------------
def compare(star_fact: DataFrame, copy: DataFrame, keys: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """One row (star_rows, copy_rows, stale_rows); stale are rows on both sides of which a value differs. Each side is read once."""
    a = star_fact.select(*keys, *[F.col(v).alias(f"_star_{v}") for v in values], F.lit(True).alias("_in_star"))
    b = copy.select(*keys, *[F.col(v).alias(f"_copy_{v}") for v in values], F.lit(True).alias("_in_copy"))
    differ = F.lit(False)
    for v in values:
        differ = differ | differs(F.col(f"_star_{v}"), F.col(f"_copy_{v}"))
    return a.join(b, list(keys), "full").agg(
        F.count("_in_star").alias("star_rows"), F.count("_in_copy").alias("copy_rows"),
        F.count_if(F.col("_in_star") & F.col("_in_copy") & differ).alias("stale_rows"),
    )


def sync_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table the rows of star and copy, and a verdict by rows and values. ``tables`` has the results of ``compare``."""
    out = None
    for name, found in tables.items():
        same = (F.col("star_rows") == F.col("copy_rows")) & (F.col("stale_rows") == 0)
        row = found.select(F.lit(name).alias("metric"), "star_rows", F.col("copy_rows").alias("snow_rows"),
                           F.when(same, "IN SYNC").otherwise("DRIFT").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def stale_values(star_fact: DataFrame, copy: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Rows present on both sides whose value differs."""
    other = copy.select(*keys, F.col(value).alias("_copy"))
    return star_fact.join(other, list(keys)).where(differs(F.col(value), F.col("_copy")))


def staleness(star_hourly: DataFrame, copy_hourly: DataFrame, star_alerts: DataFrame, copy_alerts: DataFrame) -> DataFrame:
    """How far the copy lags. Values matter more than counts: both sides can have
    equally many rows while the measures differ."""
    behind = F.col("star_rows") - F.col("copy_rows")
    hours = compare(star_hourly, copy_hourly, HOURLY_KEYS, ("units_produced",)).select(
        behind.alias("hourly_rows_behind"), F.col("stale_rows").alias("rows_with_stale_values"))
    raised = compare(star_alerts, copy_alerts, ALERT_KEYS, ()).select(behind.alias("alert_rows_behind"))
    return hours.crossJoin(raised).select("hourly_rows_behind", "alert_rows_behind", "rows_with_stale_values")  # one row each


def closed_hours(hourly: DataFrame, as_of: Column) -> DataFrame:
    return hourly.where(F.col("window_end") <= F.date_trunc("hour", as_of))


def equivalence(star_hourly: DataFrame, copy_hourly: DataFrame) -> DataFrame:
    """Totals over the same closed hours on both sides, with a verdict."""
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.sum("units_produced").cast("bigint").alias(f"{side}_units"),
            F.sum("good_units").cast("bigint").alias(f"{side}_good"),
            F.round(num(F.sum("kw_seconds")) / 3600, 2).alias(f"{side}_kwh"),
        )

    star = star_hourly.join(copy_hourly.select(*HOURLY_KEYS), list(HOURLY_KEYS), "left_semi")
    same = F.lit(True)
    for part in ("units", "good", "kwh"):
        same = same & (F.col(f"star_{part}") == F.col(f"snow_{part}"))
    return totals(star, "star").crossJoin(totals(copy_hourly, "snow")).withColumn(
        "verdict", F.when(same, "MATCH").otherwise("MISMATCH")
    )


FIXED_BYTES = {"bigint": 8, "timestamp": 8, "double": 8, "int": 4, "date": 4, "smallint": 2, "boolean": 1}


def table_bytes(tables: list[DataFrame], design: str) -> DataFrame:
    """(design, rows, bytes) of tables together: texts by their bytes, other columns by their width."""
    out = None
    for df in tables:
        width = F.lit(0).cast("bigint")
        for name, kind in df.dtypes:
            width = width + (F.coalesce(F.octet_length(name), F.lit(0)) if kind == "string" else F.lit(FIXED_BYTES[kind]))
        part = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b"))
        out = part if out is None else out.unionByName(part)
    return out.agg(F.lit(design).alias("design"), F.sum("n").alias("rows"), F.sum("b").alias("bytes"))
