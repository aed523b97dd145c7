"""Conformed key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNKNOWN

# Shift starts in minutes after midnight, plausible temperature range.
SHIFT_STARTS = ((1, 360), (2, 840), (3, 1320))
PLAUSIBLE_TEMPERATURE_C = (-20, 150)


def date_key(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).cast("smallint")


def shift_key(minute_of_day: Column) -> Column:
    (morning, m0), (afternoon, a0), (night, n0) = SHIFT_STARTS
    return (
        F.when(minute_of_day.between(m0, a0 - 1), morning)
        .when(minute_of_day.between(a0, n0 - 1), afternoon)
        .otherwise(night)
        .cast("smallint")
    )


def flags_key(temperature: Column) -> Column:
    low, high = PLAUSIBLE_TEMPERATURE_C
    inside = F.coalesce(temperature.between(low, high), F.lit(True))
    return F.when(inside, 1).otherwise(2).cast("smallint")


def or_unknown(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN))


def hashed_key(*parts: Column) -> Column:
    """60-bit key of a natural key: no counter, no global sort, same on every load.

    Parts are joined so that no two lists of parts give one text: bars inside a part are escaped and a missing part has a mark of its own.
    """
    escaped = [F.replace(F.replace(p.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for p in parts]
    text = F.concat_ws("|", *[F.coalesce(e, F.lit("\\N")) for e in escaped])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
