"""Null-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Division that yields null on a zero or missing denominator."""
    return F.try_divide(num(top), num(bottom))


def percent(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    return F.round(F.try_divide(num(top) * 100, num(bottom)), digits)


def steady_sum(col: str, digits: int = 9) -> Column:
    """Sum of doubles through a decimal of so many digits: the same whatever the task order."""
    return num(F.sum(F.col(col).cast(f"decimal(20,{digits})")))


def steady_mean(col: str, digits: int = 9) -> Column:
    return F.try_divide(steady_sum(col, digits), num(F.count(col)))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(6e7)


def null_as_zero(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0))


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)
