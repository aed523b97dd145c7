"""Text expressions: masking, JSON rows, report lines, retention names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(col: Column, limit: int) -> Column:
    return F.substring(col, 1, limit)


def mask_email(col: Column, privileged: bool | Column = False) -> Column:
    """First character and domain stay; a privileged reader sees the raw value."""
    hidden = F.regexp_replace(F.coalesce(col, F.lit("")), r"(.).*(@.*)", "$1***$2")
    if isinstance(privileged, bool):
        return col if privileged else hidden
    return F.when(privileged, col).otherwise(hidden)


def row_json(*cols: str) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def report_line(*cells: tuple[Column, int]) -> Column:
    """Fixed-width line: every cell padded on the right."""
    return F.concat(*[F.rpad(F.coalesce(c.cast("string"), F.lit("")), w, " ") for c, w in cells])


def contains(col: Column, *needles: str) -> Column:
    """Case-insensitive containment of any needle; null counts as no."""
    hit = F.lit(False)
    for needle in needles:
        hit = hit | col.ilike(f"%{needle}%")
    return F.coalesce(hit, F.lit(False))


def month_of_partition(name: Column) -> Column:
    """First day of the month named by a trailing yyyyMM or yyyy_MM; null for other names."""
    digits = F.regexp_replace(F.regexp_extract(name, r"(\d{4}_?\d{2})$", 1), "_", "")
    return F.when(F.length(digits) == 6, F.to_date(F.concat(digits, F.lit("01")), "yyyyMMdd"))
