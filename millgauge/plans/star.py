"""The star model over one stream of readings, built lazily."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts, dimensions, downtime, production
from ..sources import seeds, tables
from ..sources.store import Store

# Facts that a written star holds, and the time each is partitioned by.
STORED = {
    "sensor": "event_ts", "hourly": "window_start", "minute_kpis": "window_start", "alerts": "raised_at",
    "downtime": "started_at", "failure_alerts": "event_time", "downtime_events": "start_time",
}


class Star:
    """Dimensions and facts derived from readings; every member is a DataFrame plan.

    ``write`` stores the facts and ``open`` reads them back, in place of the plans.
    """

    base: str | None = None

    def __init__(
        self,
        readings: DataFrame,
        master: DataFrame | None = None,
        rearm_minutes: float = alerts.REARM_MINUTES,
        reading_seconds: int = production.READING_SECONDS,
    ) -> None:
        self.spark: SparkSession = readings.sparkSession
        self.readings = readings
        self.rearm_minutes = rearm_minutes
        self.reading_seconds = reading_seconds
        self._master = master

    @classmethod
    def from_tables(cls, spark: SparkSession, folder: str, **kw) -> "Star":
        return cls(tables.telemetry(tables.table(spark, folder, "events")), **kw)

    # ---- written once, read by everything downstream ----
    def write(self, base: str) -> "Star":
        """Store the facts below ``base``. Readings are conformed once; every fact is computed from what was stored of them."""
        kw = {"master": self._master, "rearm_minutes": self.rearm_minutes, "reading_seconds": self.reading_seconds}
        Store.like(self.conformed, f"{base}/conformed", "event_time").overwrite(self.conformed)
        source = self._over(self.spark, base, kw)
        for name, ts in STORED.items():
            fact = getattr(source, name)
            Store.like(fact, f"{base}/{name}", ts).overwrite(fact)
        source.readings.select("machine_id").distinct().write.mode("overwrite").parquet(f"{base}/machine_ids")
        return self.open(self.spark, base, **kw)

    @classmethod
    def _over(cls, spark: SparkSession, base: str, kw: dict) -> "Star":
        conformed = Store.open(spark, f"{base}/conformed").read()
        out = cls(conformed.select(*tables.TELEMETRY), **kw)
        out.__dict__["conformed"] = conformed
        return out

    @classmethod
    def open(cls, spark: SparkSession, base: str, **kw) -> "Star":
        """A star whose facts are the stored ones."""
        out = cls._over(spark, base, kw)
        out.base = base
        for name in STORED:
            out.__dict__[name] = Store.open(spark, f"{base}/{name}").read()
        out.__dict__["machine_ids"] = spark.read.schema("machine_id string").parquet(f"{base}/machine_ids")
        return out

    def store(self, name: str) -> Store:
        return Store.open(self.spark, f"{self.base}/{name}")

    @cached_property
    def newest_reading(self) -> Column:
        """Time of the newest reading as a literal, so that filters on it reach the scan; null without readings."""
        micros = self.readings.agg(F.unix_micros(F.max("event_time"))).first()[0]
        return F.timestamp_micros(F.lit(micros).cast("bigint"))

    @cached_property
    def machine_ids(self) -> DataFrame:
        """Every machine that ever sent a reading."""
        return self.readings.select("machine_id").distinct()

    # ---- dimensions ----
    @cached_property
    def master(self) -> DataFrame:
        return self._master if self._master is not None else seeds.machine_master(self.spark)

    @cached_property
    def machines(self) -> DataFrame:
        return dimensions.load_machines(self.master)

    @cached_property
    def statuses(self) -> DataFrame:
        return seeds.statuses(self.spark)

    @cached_property
    def alert_types(self) -> DataFrame:
        return seeds.alert_types(self.spark)

    @cached_property
    def shifts(self) -> DataFrame:
        return seeds.shifts(self.spark)

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.dim_date(self.spark)

    @cached_property
    def minutes_of_day(self) -> DataFrame:
        return dimensions.dim_time(self.spark)

    # ---- facts ----
    @cached_property
    def conformed(self) -> DataFrame:
        return production.conform(self.readings, self.machines, self.statuses)

    @cached_property
    def sensor(self) -> DataFrame:
        return production.sensor_fact(self.conformed, self.reading_seconds)

    @cached_property
    def hourly(self) -> DataFrame:
        return production.hourly_fact(self.conformed, self.reading_seconds)

    @cached_property
    def minute_kpis(self) -> DataFrame:
        return production.minute_kpis(self.readings)

    @cached_property
    def alerts(self) -> DataFrame:
        """Alert fact with lifecycle: every third reading id counts as acknowledged
        after 10 minutes and resolved after 25, then judged against its target."""
        raised = alerts.raise_alerts(self.conformed, self.alert_types, self.rearm_minutes)
        ack = F.col("reading_id") % 3 == 0
        who = F.when(ack, F.concat(F.lit("operator"), F.col("reading_id") % 7, F.lit("@contoso.com")))
        return alerts.evaluate_sla(
            raised.withColumns(
                {
                    "acknowledged_at": F.when(ack, F.col("raised_at") + F.expr("INTERVAL 10 MINUTES")),
                    "resolved_at": F.when(ack, F.col("raised_at") + F.expr("INTERVAL 25 MINUTES")),
                    "acknowledged_by": who,
                }
            ),
            self.alert_types,
        )

    @cached_property
    def downtime(self) -> DataFrame:
        return downtime.downtime_fact(self.conformed)

    # ---- first-generation tables ----
    @cached_property
    def failure_alerts(self) -> DataFrame:
        return alerts.exclusive_alerts(self.readings).withColumn(
            "acknowledged", F.col("alert_id") % 3 == 0
        )

    @cached_property
    def downtime_events(self) -> DataFrame:
        return downtime.status_episodes(self.readings)

    @cached_property
    def planned_time(self) -> DataFrame:
        span = dimensions.date_span(
            self.readings.select(F.to_date("event_time").alias("d")), "d"
        )
        return dimensions.planned_time(self.master, span)
