"""Calendar and clock attributes of a date or minute column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import keys

FISCAL_START_MONTH = 4


def fiscal_month(month: Column) -> Column:
    return (month + (12 - FISCAL_START_MONTH)) % 12 + 1


def fiscal_year(year: Column, month: Column) -> Column:
    return year + (month >= FISCAL_START_MONTH).cast("int")


def calendar(date: Column) -> dict[str, Column]:
    month, year = F.month(date), F.year(date)
    weekday = F.weekday(date) + 1
    return {
        "date_key": keys.date_key(date),
        "full_date": date,
        "day_of_week": weekday,
        "day_name": F.date_format(date, "EEEE"),
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "iso_week": F.format_string(
            "%d-W%02d", F.date_part(F.lit("YEAROFWEEK"), date), F.weekofyear(date)
        ),
        "month_number": month,
        "month_name": F.date_format(date, "MMMM"),
        "month_year": F.date_format(date, "MMM yyyy"),
        "quarter_number": F.quarter(date),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(date)),
        "year_number": year,
        "fiscal_month": fiscal_month(month),
        "fiscal_quarter": F.floor((fiscal_month(month) - 1) / 3).cast("int") + 1,
        "fiscal_year": fiscal_year(year, month),
        "is_weekend": weekday > 5,
        "is_working_day": weekday <= 5,
        "month_start_date": F.trunc(date, "month"),
        "month_end_date": F.last_day(date),
    }


# First hour of each named part of the day.
DAY_PARTS = ((21, "Night"), (17, "Evening"), (12, "Afternoon"), (5, "Morning"))


def day_part(hour: Column) -> Column:
    out = F.when(hour >= DAY_PARTS[0][0], DAY_PARTS[0][1])
    for start, label in DAY_PARTS[1:]:
        out = out.when(hour >= start, label)
    return out.otherwise("Night")


def clock(minute: Column) -> dict[str, Column]:
    hour = F.floor(minute / 60).cast("int")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return {
        "time_key": minute.cast("smallint"),
        "time_value": F.concat(two(hour), F.lit(":"), two(minute % 60), F.lit(":00")),
        "hour_24": hour,
        "hour_12": (hour + 11) % 12 + 1,
        "minute_of_hour": (minute % 60).cast("int"),
        "am_pm": F.when(hour < 12, "AM").otherwise("PM"),
        "hour_bucket": F.concat(two(hour), F.lit(":00 - "), two((hour + 1) % 24), F.lit(":00")),
        "shift_key": keys.shift_key(minute),
        "day_part": day_part(hour),
    }
