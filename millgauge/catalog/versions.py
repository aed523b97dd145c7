"""Two versions of one machine for the history queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import scd2
from . import sql

CHANGED = "M-104"
CHANGED_AT = "2024-01-16 00:00:00"

sql.RELATIONS["versions"] = f"""
SELECT machine_key, machine_id, machine_name, machine_type, production_line, criticality, ideal_cycle_time_sec, valid_from,
  CASE WHEN machine_id = '{CHANGED}' THEN TIMESTAMP '{CHANGED_AT}' ELSE valid_to END AS valid_to, machine_id <> '{CHANGED}' AS is_current
FROM dim_machine
UNION ALL
SELECT {sql.key(f"machine_id || '|{CHANGED_AT}'")}, machine_id, 'Hydraulic Press 1B', machine_type, 'LINE-A', criticality, 22.0,
  TIMESTAMP '{CHANGED_AT}', TIMESTAMP '9999-12-31 23:59:59', TRUE
FROM dim_machine WHERE machine_id = '{CHANGED}'"""


def changed_master(x) -> DataFrame:
    """The machine rows as master data states them after the change."""
    hit = F.col("machine_id") == CHANGED
    return x.star.machines.where("machine_key > 0").withColumns(
        {
            "machine_name": F.when(hit, "Hydraulic Press 1B").otherwise(F.col("machine_name")),
            "production_line": F.when(hit, "LINE-A").otherwise(F.col("production_line")),
            "ideal_cycle_time_sec": F.when(hit, F.lit(22).cast("decimal(10,2)")).otherwise(F.col("ideal_cycle_time_sec")),
        }
    )


def versions(x) -> DataFrame:
    return scd2.apply_versions(x.star.machines, changed_master(x), F.lit(CHANGED_AT).cast("timestamp"))
