"""Declared schemas: payload, broker envelope, operational tables."""

from __future__ import annotations

from pyspark.sql import types as T

PAYLOAD = T.StructType(
    [
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("power_kw", T.DoubleType()),
        T.StructField("vibration_mm_s", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("units_produced", T.IntegerType()),
        T.StructField("good_units", T.IntegerType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

BATCH_LOG = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("batch_id", T.StringType()),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_detail", T.StringType()),
    ]
)

# Exact types for stored measures: sums of decimals do not depend on the order
# in which partitions arrive, sums of doubles do.
GAUGE = T.DecimalType(10, 3)
OPEN_END = "9999-12-31 23:59:59"
FIRST_START = "1970-01-01 00:00:00"
UNKNOWN = -1
