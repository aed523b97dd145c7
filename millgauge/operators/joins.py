"""Joins to dimensions, versions and scopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import OPEN_END

BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimiser size estimate; an upper guess for everything but scans and VALUES."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when the estimate is under the limit.

    Past the limit the join keeps both sides partitioned and adaptive execution
    splits whatever key is hot.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def lookup(
    facts: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "left"
) -> DataFrame:
    """Fact-to-dimension join; ``on`` is shared names or a condition."""
    return facts.join(small(dim), on, how)


def with_as_of(df: DataFrame, ts: str, as_of: Column | None = None, name: str = "as_of") -> DataFrame:
    """Reference instant as a column: given, or the newest value of ``ts``."""
    if as_of is not None:
        return df.withColumn(name, as_of)
    newest = df.agg(F.max(ts).alias(name))
    return df.crossJoin(F.broadcast(newest))  # one row by construction


def version_windows(versions: DataFrame, key: str) -> DataFrame:
    """Make the first version of every key reach back to the beginning of time."""
    first = F.min("valid_from").over(Window.partitionBy(key))
    return versions.withColumn(
        "_from", F.when(F.col("valid_from") == first, F.lit("0001-01-01").cast("timestamp"))
        .otherwise(F.col("valid_from"))
    )


def as_of_version(
    facts: DataFrame, versions: DataFrame, key: str, ts: str, reach_back: bool = True
) -> DataFrame:
    """Attach the version valid at ``ts``: equality on the key, range as residual.

    Rows older than the first version take the first one; ``reach_back=False`` saves
    that step for dimensions whose first versions start before all facts. ``versions``
    must not share other column names with ``facts``.
    """
    dim = version_windows(versions, key) if reach_back else versions.withColumn("_from", F.col("valid_from"))
    dim = dim.withColumnRenamed(key, "_vkey")
    hit = (
        (F.col(key) == F.col("_vkey"))
        & (F.col(ts) >= F.col("_from"))
        & ((F.col(ts) < F.col("valid_to")) | (F.col("valid_to") == F.lit(OPEN_END).cast("timestamp")))
    )
    return lookup(facts, dim, hit).drop("_vkey", "_from")


def _wildcard(columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(f"s.{c}").isNull() | (F.col(f"s.{c}") == F.col(f"m.{c}")))
    return cond


def wildcard_scope(members: DataFrame, scopes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Members matched by any scope row; a null scope cell matches every value."""
    return members.alias("m").join(small(scopes).alias("s"), _wildcard(columns), "left_semi")


def wildcard_members(members: DataFrame, scopes: DataFrame, columns: Sequence[str], owner: str, keep: Sequence[str]) -> DataFrame:
    """(owner, kept columns) of the members that each owner's scope rows match, in one join over all owners."""
    met = members.alias("m").join(small(scopes).alias("s"), _wildcard(columns))
    return met.select(F.col(f"s.{owner}"), *[F.col(f"m.{c}") for c in keep]).distinct()


def hour_scaffold(spark_dates: DataFrame) -> DataFrame:
    """Every date with hours 0 to 23; grows with days, not with facts."""
    return spark_dates.withColumn("hour_24", F.explode(F.sequence(F.lit(0), F.lit(23))))


def denormalise(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One-to-many relationships for measures: key column → dimension."""
    out = facts
    for key, dim in dims.items():
        out = lookup(out, dim, key)
    return out
