"""Time intelligence over daily components.

Facts are reduced to one row per date (and group) first; windows run over that
small result. Ratios come last, from windowed sums, never from windowed ratios.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dimensions import date_span
from .measures import WINDOW_PARTS

PERIODS = {"mtd": "month", "qtd": "quarter", "ytd": "year"}


def daily_axis(daily: DataFrame, date: str, parts: Sequence[str] = WINDOW_PARTS) -> DataFrame:
    """Every date of the span once, with components where there are any."""
    return date_span(daily, date).withColumnRenamed("full_date", date).join(
        daily.select(date, *parts), date, "left"
    )


def _sums(frame, parts: Sequence[str]) -> dict[str, Column]:
    return {p: F.sum(p).over(frame) for p in parts}


def period_to_date(
    daily: DataFrame, date: str, period: str, group: Sequence[str] = (), parts: Sequence[str] = WINDOW_PARTS
) -> DataFrame:
    """Components summed from the start of the month, quarter or year to each date."""
    frame = (
        Window.partitionBy(*group, F.trunc(date, PERIODS.get(period, period)))
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumns(_sums(frame, parts))


def rolling(
    daily: DataFrame, date: str, days: int, group: Sequence[str] = (), parts: Sequence[str] = WINDOW_PARTS
) -> DataFrame:
    """Components summed over the ``days`` ending at each date; gaps in dates are fine."""
    number = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*group).orderBy(number).rangeBetween(-(days - 1), 0)
    return daily.withColumns(_sums(frame, parts))


def shifted(
    daily: DataFrame, date: str, value: str, months: int, name: str, group: Sequence[str] = ()
) -> DataFrame:
    """Value of the same date ``months`` back. The earlier row moves forward, so a date
    that does not exist there (29 February, month ends) simply has no partner."""
    before = daily.select(
        *group, F.col(date).alias("_then"), F.col(value).alias(name)
    )
    cond = F.col("_then") == F.add_months(F.col(date), -months)
    for g in group:
        cond = cond & (daily[g] == before[g])
    joined = daily.join(before, cond, "left")
    for g in group:
        joined = joined.drop(before[g])
    return joined.drop("_then")


def monthly(daily: DataFrame, date: str, group: Sequence[str] = (), parts: Sequence[str] = WINDOW_PARTS) -> DataFrame:
    return daily.groupBy(*group, F.trunc(date, "month").alias("month_start")).agg(
        *[F.sum(p).alias(p) for p in parts]
    )


def previous_month(months: DataFrame, value: str, name: str, group: Sequence[str] = ()) -> DataFrame:
    """Value of the calendar month before; a missing month gives null, not the one before it."""
    return shifted(months, "month_start", value, 1, name, group)


def growth(now: Column, before: Column) -> Column:
    return F.try_divide(now - before, before)


def time_calculations(
    daily: DataFrame, date: str, measure: Column, parts: Sequence[str] = WINDOW_PARTS
) -> DataFrame:
    """One measure under every calculation: current, to-date sums, last year, change on it.

    All windowed sums come from one pass; each date then turns into one row per
    calculation, so the measure is written once whatever it is.
    """
    frames = {
        name: Window.partitionBy(F.trunc(date, span)).orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for name, span in PERIODS.items()
    }
    wide = daily.select(
        date, *parts, *[c.alias(f"{n}__{p}") for n, f in frames.items() for p, c in _sums(f, parts).items()]
    )
    variant = lambda label, prefix: F.struct(
        F.lit(label).alias("calculation"),
        *[F.col(prefix + p).cast(_wide(daily, p)).alias(p) for p in parts],
    )
    rows = wide.select(
        date,
        F.inline(F.array(variant("current", ""), *[variant(n, f"{n}__") for n in PERIODS])),
    ).select(date, "calculation", measure.alias("value"))
    pick = lambda n: F.max(F.when(F.col("calculation") == n, F.col("value"))).alias(n)
    out = rows.groupBy(date).agg(*[pick(n) for n in ("current", *PERIODS)])
    out = shifted(out, date, "current", 12, "py")
    return out.withColumn("yoy", growth(F.col("current"), F.col("py")))


def _wide(df: DataFrame, part: str) -> str:
    """Type that holds both a component and its windowed sum."""
    kind = df.schema[part].dataType.typeName()
    return {"decimal": "decimal(38,5)", "double": "double"}.get(kind, "bigint")
