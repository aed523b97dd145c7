"""Small per-batch state tables next to the stream's output.

Each micro-batch writes the state it leaves behind under its own batch id and
reads the one of the batch before. A batch that is run again after a failure
therefore starts from the same state and replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.sinks import batch_path, write_batch

OPEN_STOPS = T.StructType(
    [T.StructField("machine_id", T.StringType()), T.StructField("open_started_at", T.TimestampType())]
)
OFFSETS = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
    ]
)
KEPT_STATES = 3  # a stream only ever runs its last batch again
LAST_SEEN = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("alert_code", T.StringType()),
        T.StructField("last_seen", T.TimestampType()),
    ]
)


def state_before(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """State left by the batch before this one; batch ids are consecutive from 0.

    The folder is read by name, so the cost does not grow with the number of batches. A missing folder
    is an error for every batch but the first: going on without would forget open stops and raised alerts.
    """
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(batch_path(path, batch_id - 1))


def save_state(state: DataFrame, path: str, batch_id: int) -> None:
    """Write the state and remove the one that no batch can start from any more."""
    write_batch(state, path, batch_id)
    if batch_id >= KEPT_STATES:
        spark = state.sparkSession
        old = spark._jvm.org.apache.hadoop.fs.Path(batch_path(path, batch_id - KEPT_STATES))
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
