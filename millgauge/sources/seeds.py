"""Fixed reference rows, as VALUES relations so the optimiser knows their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import FIRST_START


def values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """Rows from literals; ``columns`` is ``name type, …``."""
    fields = [c.strip().split(" ", 1) for c in columns.split(";")]
    names = ", ".join(name for name, _ in fields)
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    cast = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    return spark.sql(f"SELECT {cast} FROM VALUES {body} AS t({names})")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, float)):
        return str(value)
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


# ---- Fixed values: seed rows of the small dimensions -------------------------

SHIFT_COLUMNS = (
    "shift_key smallint; shift_code string; shift_name string; start_time string; "
    "end_time string; planned_minutes int; crosses_midnight boolean"
)
SHIFTS = [
    (-1, "?", "Unknown", "00:00:00", "00:00:00", 0, False),
    (1, "A", "Morning Shift", "06:00:00", "14:00:00", 480, False),
    (2, "B", "Afternoon Shift", "14:00:00", "22:00:00", 480, False),
    (3, "C", "Night Shift", "22:00:00", "06:00:00", 480, True),
]

STATUS_COLUMNS = (
    "status_key smallint; status_code string; status_name string; status_category string; "
    "is_productive boolean; is_downtime boolean; is_planned_downtime boolean; "
    "counts_toward_oee boolean; display_colour_hex string; sort_order int"
)
STATUSES = [
    (-1, "UNKNOWN", "Unknown", "UNKNOWN", False, False, False, False, "#9E9E9E", 99),
    (1, "RUNNING", "Running", "PRODUCTIVE", True, False, False, True, "#2E7D32", 1),
    (2, "IDLE", "Idle / Starved", "UNPLANNED", False, True, False, True, "#F9A825", 2),
    (3, "DOWN", "Stopped", "UNPLANNED", False, True, False, True, "#EF6C00", 3),
    (4, "FAULT", "Fault / Breakdown", "UNPLANNED", False, True, False, True, "#C62828", 4),
    (5, "MAINTENANCE", "Planned Maintenance", "PLANNED", False, True, True, False, "#1565C0", 5),
    (6, "SETUP", "Changeover / Setup", "PLANNED", False, True, True, False, "#6A1B9A", 6),
]

ALERT_TYPE_COLUMNS = (
    "alert_type_key smallint; alert_code string; alert_name string; alert_category string; "
    "severity string; severity_rank smallint; sla_response_minutes int; "
    "requires_shutdown boolean; display_colour_hex string"
)
ALERT_TYPES = [
    (1, "FAULT_STATUS", "Machine Fault Reported", "MECHANICAL", "CRITICAL", 1, 15, True, "#C62828"),
    (2, "HIGH_TEMP", "Temperature Above Threshold", "THERMAL", "HIGH", 2, 30, False, "#EF6C00"),
    (3, "HIGH_VIBRATION", "Vibration Above Threshold", "MECHANICAL", "HIGH", 2, 30, False, "#EF6C00"),
    (4, "POWER_ANOMALY", "Power Draw Anomaly", "ELECTRICAL", "MEDIUM", 3, 60, False, "#F9A825"),
    (5, "QUALITY_DRIFT", "Scrap Rate Elevated", "PROCESS", "MEDIUM", 3, 120, False, "#F9A825"),
    (6, "PREDICTIVE_RISK", "Predictive Maintenance Flag", "PROCESS", "LOW", 4, 480, False, "#1565C0"),
]
UNKNOWN_ALERT_TYPE = (-1, "UNKNOWN", "Unknown Alert", "UNKNOWN", "UNKNOWN", 9, 0, False, "#9E9E9E")

FLAG_COLUMNS = (
    "flags_key smallint; is_outlier boolean; is_backfilled boolean; is_estimated boolean; "
    "flag_description string"
)
FLAGS = [
    (1, False, False, False, "Clean reading"),
    (2, True, False, False, "Statistical outlier"),
    (3, False, True, False, "Backfilled from late-arriving data"),
    (4, False, False, True, "Estimated / interpolated"),
    (5, True, True, False, "Outlier, backfilled"),
    (6, True, False, True, "Outlier, estimated"),
    (7, False, True, True, "Backfilled, estimated"),
    (8, True, True, True, "Outlier, backfilled, estimated"),
]

MASTER_COLUMNS = (
    "machine_id string; machine_name string; machine_type string; location string; "
    "ideal_cycle_time_sec decimal(10,2); installed_date date; manufacturer string; "
    "rated_power_kw decimal(10,2); is_active boolean"
)
# Last three columns are ours: the public seed leaves them empty.
MACHINES = [
    ("M-101", "CNC Mill 1", "CNC", "Plant A - Line 1", 12.0, "2022-03-01", "Millco", 11.0, True),
    ("M-102", "CNC Mill 2", "CNC", "Plant A - Line 1", 12.0, "2022-03-01", "Millco", 11.0, True),
    ("M-103", "Conveyor Belt A", "Conveyor", "Plant A - Line 1", 4.0, "2021-11-15", None, 4.0, None),
    ("M-104", "Hydraulic Press 1", "Press", "Plant A - Line 2", 20.0, "2023-01-10", "Presswerk", 18.0, True),
    ("M-105", "Packaging Robot 1", "Robot", "Plant A - Line 2", 6.5, "2023-06-20", None, 7.5, True),
]

SCOPE_COLUMNS = (
    "user_principal_name string; plant_code string; production_line string; role_name string; "
    "is_active boolean"
)
SCOPES = [
    ("exec@contoso.com", None, None, "EXECUTIVE", True),
    ("plant.mgr@contoso.com", "PLANT-01", None, "PLANT_MANAGER", True),
    ("linea.sup@contoso.com", "PLANT-01", "LINE-A", "LINE_SUPERVISOR", True),
    ("lineb.sup@contoso.com", "PLANT-01", "LINE-B", "LINE_SUPERVISOR", True),
    ("old.sup@contoso.com", "PLANT-01", "LINE-B", "LINE_SUPERVISOR", False),
]


def shifts(spark: SparkSession) -> DataFrame:
    return values(spark, SHIFT_COLUMNS, SHIFTS)


def statuses(spark: SparkSession) -> DataFrame:
    return values(spark, STATUS_COLUMNS, STATUSES)


def alert_types(spark: SparkSession, with_unknown: bool = True) -> DataFrame:
    rows = [UNKNOWN_ALERT_TYPE, *ALERT_TYPES] if with_unknown else ALERT_TYPES
    return values(spark, ALERT_TYPE_COLUMNS, rows)


def reading_flags(spark: SparkSession) -> DataFrame:
    return values(spark, FLAG_COLUMNS, FLAGS)


def machine_master(spark: SparkSession) -> DataFrame:
    return values(spark, MASTER_COLUMNS, MACHINES)


def user_scopes(spark: SparkSession) -> DataFrame:
    return values(spark, SCOPE_COLUMNS, SCOPES)


def unknown_machine(spark: SparkSession) -> DataFrame:
    """The row that unresolved machine keys point at."""
    return values(
        spark,
        "machine_key bigint; machine_id string; machine_name string; machine_type string; "
        "location string; production_line string; plant_code string; installed_date date; "
        "ideal_cycle_time_sec decimal(10,2); manufacturer string; rated_power_kw decimal(10,2); "
        "criticality string; is_active boolean; is_inferred boolean; valid_from timestamp; "
        "valid_to timestamp; is_current boolean",
        [
            (-1, "UNKNOWN", "Unknown Machine", "UNKNOWN", None, "UNKNOWN", "UNKNOWN", None, 1.0,
             None, None, "LOW", True, True, FIRST_START, "9999-12-31 23:59:59", True)
        ],
    )
