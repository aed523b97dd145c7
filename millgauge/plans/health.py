"""Operational health views. ``as_of`` is a column expression for the reference instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import band
from ..functions.numeric import num, percent, seconds_between
from ..operators.joins import lookup
from ..sources.sinks import run_outcomes


def _after(ts: str, as_of: Column, span: str) -> Column:
    return F.col(ts) > as_of - F.expr(f"INTERVAL {span}")


def _one(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def _fresh(as_of: Column) -> dict[str, Column]:
    lag = seconds_between(F.col("latest_reading"), as_of)
    return {
        "latest_reading": F.col("latest_reading"),
        "lag_seconds": F.round(lag).cast("bigint"),
        "status": band((F.col("latest_reading").isNull(), "NO DATA"), (lag < 120, "HEALTHY"), (lag < 600, "DEGRADED"), otherwise="STALLED"),
    }


def freshness(sensor: DataFrame, as_of: Column, ts: str = "event_ts") -> DataFrame:
    return sensor.agg(F.max(ts).alias("latest_reading")).select(*_one(_fresh(as_of)))


def batch_health(log: DataFrame, as_of: Column) -> DataFrame:
    """Finished runs of the last day; a run counts once however many rows it logged."""
    good, bad = F.col("status") == "SUCCESS", F.col("status") == "FAILED"
    counted = run_outcomes(log).where("status <> 'RUNNING'").where(_after("started_at", as_of, "24 HOURS")).agg(
        F.count("*").alias("batches_24h"),
        F.count_if(good).alias("succeeded"),
        F.count_if(bad).alias("failed"),
        F.max(F.when(bad, F.col("completed_at"))).alias("last_failure_at"),
    )
    share = F.try_divide(num("succeeded") * 100, num("batches_24h"))
    return counted.select(
        "batches_24h", "succeeded", "failed",
        percent("succeeded", "batches_24h").alias("success_rate_pct"),
        "last_failure_at",
        band((F.col("batches_24h") == 0, "NO BATCHES"), (share >= 99, "HEALTHY"), (share >= 95, "DEGRADED"),
             otherwise="UNHEALTHY").alias("status"),
    )


def _key_counts(recent: Column | None = None) -> list[Column]:
    m, s = F.col("machine_key") == -1, F.col("status_key") == -1
    among = F.lit(True) if recent is None else recent
    counted = {"rows_24h": F.lit(True), "unknown_machine": m, "unknown_status": s, "_any": m | s}
    return [F.count_if(among & c).alias(name) for name, c in counted.items()]


def _unknown() -> dict[str, Column]:
    share = F.try_divide(num("_any") * 100, num("rows_24h"))
    return {
        **{c: F.col(c) for c in ("rows_24h", "unknown_machine", "unknown_status")},
        "unknown_pct": percent("_any", "rows_24h", 4),
        "status": band((F.col("rows_24h") == 0, "NO DATA"), (share < 0.1, "HEALTHY"), otherwise="INVESTIGATE"),
    }


def unknown_key_rate(sensor: DataFrame, as_of: Column, ts: str = "event_ts") -> DataFrame:
    return sensor.where(_after(ts, as_of, "24 HOURS")).agg(*_key_counts()).select(*_one(_unknown()))


def dead_letter_health(letters: DataFrame, as_of: Column) -> DataFrame:
    """Arrivals of the last day; waiting messages of any age, and what most of them failed by, the first in name order on a tie.

    One pass: counts by reason, then those of the few reasons together.
    """
    waiting = F.col("replayed_at").isNull()
    reasons = letters.groupBy("failure_reason").agg(
        F.count_if(_after("quarantined_at", as_of, "24 HOURS")).alias("_recent"),
        F.count_if(waiting).alias("_waiting"),
        F.min(F.when(waiting, F.col("quarantined_at"))).alias("_oldest"),
    )
    ranked = F.when(F.col("_waiting") > 0, F.struct(-F.col("_waiting"), F.col("failure_reason")))
    counted = reasons.agg(
        F.coalesce(F.sum("_recent"), F.lit(0)).alias("quarantined_24h"),
        F.coalesce(F.sum("_waiting"), F.lit(0)).alias("awaiting_replay"),
        F.min("_oldest").alias("oldest_unreplayed"),
        F.min_by("failure_reason", ranked).alias("top_reason"),
    )
    return counted.withColumn(
        "status",
        F.when((F.col("quarantined_24h") == 0) & (F.col("awaiting_replay") == 0), "HEALTHY").otherwise("INVESTIGATE"),
    )


def stuck_downtime(stops: DataFrame, machines: DataFrame, as_of: Column) -> DataFrame:
    rows = lookup(stops.where("ended_at IS NULL"), machines.select("machine_key", "machine_name"), "machine_key", "inner")
    open_s = seconds_between(F.col("started_at"), as_of)
    return rows.select(
        "machine_key", "machine_name", "started_at",
        open_s.cast("bigint").alias("open_for_seconds"),
        "reason_code",
        F.when(open_s > 4 * 3600, "STUCK").otherwise("OPEN").alias("status"),
    ).orderBy("started_at")


def dashboard(
    sensor: DataFrame, log: DataFrame, letters: DataFrame, stops: DataFrame, machines: DataFrame, as_of: Column
) -> DataFrame:
    """One row per check: name, status, detail. Each fact is read once."""
    text = lambda c, missing: F.coalesce(c.cast("string"), F.lit(missing))
    check = lambda name, status, detail: F.struct(
        F.lit(name).alias("check_name"), status.alias("status"), detail.alias("detail"))
    row = lambda df, name, detail: df.select(F.lit(name).alias("check_name"), "status", detail.alias("detail"))
    fresh, known = _fresh(as_of), _unknown()
    recent = _after("event_ts", as_of, "24 HOURS")
    sensor_checks = sensor.agg(F.max("event_ts").alias("latest_reading"), *_key_counts(recent)).select(F.inline(F.array(
        check("Pipeline freshness", fresh["status"], F.concat(F.lit("Latest reading "), text(fresh["lag_seconds"], "n/a"), F.lit("s ago"))),
        check("Unknown key rate", known["status"],
              F.concat(text(known["unknown_pct"], "0"), F.lit("% of "), F.col("rows_24h"), F.lit(" rows"))),
    )))
    stuck = stuck_downtime(stops, machines, as_of).where("status = 'STUCK'").agg(F.count("*").alias("n")).withColumn(
        "status", F.when(F.col("n") == 0, "HEALTHY").otherwise("INVESTIGATE")
    )
    return (
        sensor_checks
        .unionByName(row(batch_health(log, as_of), "Batch success rate",
                         F.concat(text(F.col("success_rate_pct"), "0"), F.lit("% over "), F.col("batches_24h"), F.lit(" batches"))))
        .unionByName(row(dead_letter_health(letters, as_of), "Dead-letter queue",
                         F.concat(F.col("quarantined_24h"), F.lit(" quarantined, "), F.col("awaiting_replay"), F.lit(" awaiting replay"))))
        .unionByName(row(stuck, "Stuck downtime episodes", F.concat(F.col("n"), F.lit(" episode(s) open over 4 hours"))))
    )


PASSING = ("HEALTHY", "OK", "NO DATA")


def verdict(board: DataFrame) -> DataFrame:
    """One row: the failing checks and an exit code."""
    bad = ~F.col("status").isin(*PASSING)
    return board.agg(
        F.count("*").alias("checks"),
        F.count_if(bad).alias("unhealthy"),
        F.concat_ws(", ", F.array_sort(F.collect_list(F.when(bad, F.col("check_name"))))).alias("unhealthy_checks"),
    ).withColumn("exit_code", F.when(F.col("unhealthy") > 0, 1).otherwise(0))


def letters_by_reason(letters: DataFrame) -> DataFrame:
    return letters.where("replayed_at IS NULL").groupBy("failure_reason").agg(
        F.count("*").alias("messages"), F.min("quarantined_at").alias("oldest")
    )


def reason_summary(letters: DataFrame) -> DataFrame:
    """``reason: n`` pairs joined into one text; 'none' when the queue is empty.

    Counted per reason first, so the text grows with the kinds of failure only.
    """
    counts = letters_by_reason(letters)
    pair = F.concat(F.col("failure_reason"), F.lit(": "), F.col("messages"))
    return counts.agg(F.coalesce(F.array_join(F.array_sort(F.collect_list(pair)), "; "), F.lit("")).alias("t")).select(
        F.when(F.col("t") == "", "none").otherwise(F.col("t")).alias("summary")
    )


def alert_volume(alerts: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return alerts.where(_after("raised_at", as_of, f"{days} DAYS")).groupBy("date_key").agg(
        F.count("*").alias("alerts")
    )


def batch_outcomes(log: DataFrame, as_of: Column) -> DataFrame:
    return run_outcomes(log).where(_after("started_at", as_of, "24 HOURS")).groupBy("status").agg(
        F.count("*").alias("batches"), F.max("completed_at").alias("last_completed")
    )
