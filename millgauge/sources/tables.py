"""Table reads: the given Parquet tables, readings derived from them, partitioned facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream of files; works for a single file and for a folder of parts."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    one_file = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    if one_file:
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def file_states(spark: SparkSession, folder: str, name: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of each file of a table, through the Hadoop file system."""
    files = sorted(table(spark, folder, name).inputFiles())
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in files]
    found = [p.getFileSystem(hadoop).getFileStatus(p) for p in paths]
    return [(str(s.getPath()), s.getLen(), s.getModificationTime()) for s in found]


# How one row of ``events`` stands in for one sensor reading.
TELEMETRY = {
    "reading_id": "event_id",
    "machine_id": "concat('M-', cast(user_id % 6 + 101 AS string))",
    "event_time": "cast(ts AS timestamp)",
    "temperature_c": "cast(cast(value AS decimal(10,2)) * cast(0.5 AS decimal(2,1)) + 30 AS decimal(10,3))",
    "power_kw": "cast(cast(value AS decimal(10,2)) * cast(0.1 AS decimal(2,1)) AS decimal(10,3))",
    "vibration_mm_s": "cast(cast(event_id % 80 AS decimal(10,0)) * cast(0.1 AS decimal(2,1)) AS decimal(10,3))",
    "status": """CASE WHEN event_type = 'error' THEN if(event_id % 2 = 0, 'FAULT', 'DOWN')
        WHEN event_type = 'signup' THEN 'IDLE' WHEN event_type = 'view' THEN 'running'
        WHEN event_type = 'purchase' AND event_id % 50 = 0 THEN 'TELEPORTING' ELSE 'RUNNING' END""",
    "units_produced": "cast(if(event_type IN ('click', 'view', 'purchase'), user_id % 3 + 1, 0) AS int)",
    "good_units": """cast(if(event_type IN ('click', 'view', 'purchase'),
        user_id % 3 + 1 - if(event_id % 33 = 0, 1, 0), 0) AS int)""",
}


def telemetry(events: DataFrame) -> DataFrame:
    return events.selectExpr(*[f"{text} AS {name}" for name, text in TELEMETRY.items()])


def line_output(lineitem: DataFrame) -> DataFrame:
    """Order lines read as production records of a supplier: years of dates for the
    time calculations that a month of events cannot show."""
    units = F.col("l_quantity").cast("int")
    run = (units * 40 + 600).cast("bigint")
    return lineitem.select(
        F.col("l_suppkey").alias("machine_key"),
        F.to_date("l_shipdate").alias("full_date"),
        units.alias("units_produced"),
        (units - F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("good_units"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("scrap_units"),
        run.alias("runtime_seconds"),
        F.lit(0).cast("bigint").alias("idle_seconds"),
        (3600 - run).alias("downtime_seconds"),
        (F.col("l_linenumber") * 60).cast("bigint").alias("planned_stop_seconds"),
        F.lit(60.0).alias("planned_minutes"),
        (F.col("l_suppkey") % 30 + 10).cast("decimal(10,2)").alias("ideal_cycle_time_sec"),
    )


def read_months(
    spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime, ts: str = "event_ts"
) -> DataFrame:
    """Fact rows in ``[start, end)`` UTC; the month bounds reach the partition filter."""
    instant = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    return spark.read.parquet(path).where(
        F.col("event_month").between(start.strftime("%Y%m"), end.strftime("%Y%m"))
        & (F.col(ts) >= instant(start))
        & (F.col(ts) < instant(end))
    )
