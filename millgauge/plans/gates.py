"""Quality gates: actions on one-row health views that pass or raise."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LAG_SECONDS = 300
MIN_BATCH_SUCCESS_PCT = 99.0
MAX_UNKNOWN_PCT = 0.1
MAX_WAITING_LETTERS = 0


class GateFailed(Exception):
    """A quality gate was breached."""


@dataclass(frozen=True)
class GateResult:
    name: str
    passed: bool
    detail: str


def _decided(view: DataFrame, gate: str, passed: Column, detail: Column) -> DataFrame:
    """One row (gate, passed, detail) from a one-row view; a gate without a measure has not passed."""
    return view.select(F.lit(gate).alias("gate"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))


def _said(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def fresh_enough_row(view: DataFrame, limit: int = MAX_LAG_SECONDS) -> DataFrame:
    lag = F.col("lag_seconds")
    said = F.coalesce(_said("newest reading is ", lag, f"s old, limit {limit}s"), F.lit("no sensor facts at all"))
    return _decided(view, "freshness", lag <= limit, said)


def batches_succeed_row(view: DataFrame, minimum: float = MIN_BATCH_SUCCESS_PCT) -> DataFrame:
    pct, n = F.col("success_rate_pct"), F.col("batches_24h")
    said = F.coalesce(_said(pct, "% of ", n, f" batches, minimum {minimum}%"), F.lit("no batches in 24 hours"))
    return _decided(view, "batch success", (n > 0) & (pct >= minimum), said)


def keys_known_row(view: DataFrame, limit: float = MAX_UNKNOWN_PCT) -> DataFrame:
    pct = F.coalesce("unknown_pct", F.lit(0.0))
    return _decided(view, "unknown keys", pct <= limit, _said(pct, "% of ", F.col("rows_24h"), f" rows, limit {limit}%"))


def letters_replayed_row(view: DataFrame, limit: int = MAX_WAITING_LETTERS) -> DataFrame:
    waiting = F.col("awaiting_replay")
    return _decided(view, "dead letters", waiting <= limit, _said(waiting, " waiting, mostly: ", F.coalesce("top_reason", F.lit("None"))))


def no_nulls_row(view: DataFrame) -> DataFrame:
    nulls = F.lit(0)
    for c in view.columns:
        nulls = nulls + F.coalesce(F.col(c), F.lit(0))
    return _decided(view, "null ids", nulls == 0, _said(nulls, " null values"))


def copy_in_sync_row(view: DataFrame) -> DataFrame:
    stale = F.col("rows_with_stale_values")
    return _decided(view, "snowflake copy", stale == 0, _said(stale, " rows with stale values"))


def together(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def _result(row: DataFrame) -> GateResult:
    """What the driver needs to stop or go on: one row by construction."""
    found = row.first()
    return GateResult(found["gate"], found["passed"], found["detail"])


def fresh_enough(view: DataFrame, limit: int = MAX_LAG_SECONDS) -> GateResult:
    return _result(fresh_enough_row(view, limit))


def batches_succeed(view: DataFrame, minimum: float = MIN_BATCH_SUCCESS_PCT) -> GateResult:
    return _result(batches_succeed_row(view, minimum))


def keys_known(view: DataFrame, limit: float = MAX_UNKNOWN_PCT) -> GateResult:
    return _result(keys_known_row(view, limit))


def letters_replayed(view: DataFrame, limit: int = MAX_WAITING_LETTERS) -> GateResult:
    return _result(letters_replayed_row(view, limit))


def no_nulls(view: DataFrame) -> GateResult:
    return _result(no_nulls_row(view))


def copy_in_sync(view: DataFrame) -> GateResult:
    return _result(copy_in_sync_row(view))


def converge(gates: list[Callable[[], GateResult]], publish: Callable[[], None]) -> list[GateResult]:
    """Run every gate; publish only if all passed, otherwise raise with the breaches."""
    results = [g() for g in gates]
    failed = [r for r in results if not r.passed]
    if failed:
        raise GateFailed("; ".join(f"{r.name}: {r.detail}" for r in failed))
    publish()
    return results
