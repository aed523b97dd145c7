"""Threshold bands: ordered (condition, label) pairs as one CASE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(*rules: tuple[Column, str], otherwise: str) -> Column:
    out = F.when(*_pair(rules[0]))
    for rule in rules[1:]:
        out = out.when(*_pair(rule))
    return out.otherwise(otherwise)


def _pair(rule: tuple[Column, str]) -> tuple[Column, Column]:
    condition, label = rule
    return condition, F.lit(label)


def oee_colour(oee: Column) -> Column:
    return band((oee >= 0.85, "#2E7D32"), (oee >= 0.65, "#F9A825"), otherwise="#C62828")


def trend(delta: Column) -> Column:
    """Arrow and signed percentage points beyond two points either way."""
    amount = F.format_number(F.abs(delta) * 100, 1)
    return (
        F.when(delta > 0.02, F.concat(F.lit("▲ +"), amount, F.lit("%")))
        .when(delta < -0.02, F.concat(F.lit("▼ -"), amount, F.lit("%")))
        .otherwise("Flat")
    )
