"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import differs
from ..schemas import OPEN_END
from .dimensions import version_key
from .sequence import first_per

TRACKED = ("machine_name", "machine_type", "production_line", "plant_code", "ideal_cycle_time_sec", "criticality")


def row_hash(columns: Sequence[str] = TRACKED) -> Column:
    """SHA-256 over the tracked attributes as JSON, which keeps values and nulls apart."""
    return F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"}), 256)


def drift(dim: DataFrame, source: DataFrame, columns: Sequence[str] = ("machine_name", "machine_type")) -> DataFrame:
    """Current rows whose attributes differ from the source, null-aware."""
    src = source.select("machine_id", *[F.col(c).alias(f"source_{c}") for c in columns])
    changed = F.lit(False)
    for c in columns:
        changed = changed | differs(F.col(c), F.col(f"source_{c}"))
    return (
        dim.where("is_current")
        .join(src, "machine_id")
        .where(changed)
        .select(
            "machine_id",
            *[F.col(c).alias(f"current_{c}") for c in columns],
            *[f"source_{c}" for c in columns],
        )
    )


def apply_versions(dim: DataFrame, incoming: DataFrame, effective: Column, columns: Sequence[str] = TRACKED) -> DataFrame:
    """Close the current version of changed members at ``effective`` and add the new one.

    New members get a first version; unchanged members and history stay, and so do members that
    ``incoming`` lacks. ``incoming`` has the dimension's columns; of several rows of a member the one with the
    smallest hash counts. A change dated before the current version is refused with an error.
    """
    new = first_per(incoming.withColumn("_hash", row_hash(columns)), ["machine_id"], ["_hash"])
    now = dim.where("is_current").select("machine_id", row_hash(columns).alias("_old"), F.col("valid_from").alias("_since"))
    effective = F.when(effective < F.col("_since"), F.raise_error(F.concat(
        F.lit("change dated before the current version of "), F.col("machine_id")))).otherwise(effective)
    compared = new.join(now, "machine_id", "left")
    changed = compared.where(F.col("_old").isNull() | (F.col("_old") != F.col("_hash")))
    versions = (
        changed.withColumn("valid_from", F.when(F.col("_old").isNull(), F.col("valid_from")).otherwise(effective))
        .withColumn("valid_to", F.lit(OPEN_END).cast("timestamp"))
        .withColumn("is_current", F.lit(True))
        .withColumn("machine_key", version_key(F.col("machine_id"), F.col("valid_from")))
        .select(*dim.columns)
    )
    closing = changed.where(F.col("_old").isNotNull()).select("machine_id", F.lit(True).alias("_close"), "_since")
    kept = dim.join(closing, "machine_id", "left")
    close = F.col("is_current") & F.coalesce("_close", F.lit(False))
    kept = (
        kept.withColumn("valid_to", F.when(close, effective).otherwise(F.col("valid_to")))
        .withColumn("is_current", F.col("is_current") & ~close)
        .select(*dim.columns)
    )
    return kept.unionByName(versions)
