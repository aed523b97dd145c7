"""Keyed merges over DataFrames; ``sources/store.py`` has those over stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_of_partition


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows whose key is new; existing rows stay. The incoming keys must be unique."""
    new = incoming.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows with an equal key, add the others. One shuffle: union, then newest wins."""
    rest = [c for c in target.columns if c not in keys]
    both = target.withColumn("_age", F.lit(0)).unionByName(
        incoming.select(*target.columns).withColumn("_age", F.lit(1))
    )
    return (
        both.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "_age").alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*target.columns)
    )


def update_columns(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str],
    guard: Column | None = None,
) -> DataFrame:
    """Set ``columns`` from the matching incoming row, where ``guard`` holds on the target."""
    change = incoming.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    take = F.coalesce("_hit", F.lit(False))
    if guard is not None:
        take = take & F.coalesce(guard, F.lit(False))
    joined = target.join(change, list(keys), "left").withColumn("_take", take)
    return joined.select(
        *[
            (F.when(F.col("_take"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c))
            for c in target.columns
        ]
    )


def drop_orphans(copy: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return copy.join(source.select(*keys), list(keys), "left_semi")


def grain_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def touched_grain(fact: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the atomic fact that share a grain key with the batch, for a recompute."""
    return fact.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def expired_partitions(names: DataFrame, column: str, as_of: Column, months: int) -> DataFrame:
    """Month partitions older than the cutoff."""
    cutoff = F.add_months(F.trunc(as_of, "month"), -months)
    return names.where(month_of_partition(F.col(column)) < cutoff)
