"""Broker messages: source options, envelope projection, payload parsing, keyed output."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import small
from ..schemas import ENVELOPE, PAYLOAD

# The default JSON format stops at milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

ENVELOPE_COLUMNS = {
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
}


def kafka_options(servers: str, topic: str, rate_cap: int | None = 20000) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if rate_cap is not None:
        options["maxOffsetsPerTrigger"] = str(rate_cap)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, rate_cap: int | None = 20000) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, rate_cap)).load()


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows from JSON files; same columns as the broker source."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def envelope(raw: DataFrame) -> DataFrame:
    """Broker coordinates next to the raw text."""
    return raw.select(
        *[F.col(a).alias(b) for a, b in ENVELOPE_COLUMNS.items()],
        F.col("value").cast("string").alias("raw_payload"),
    )


def parse(raw: DataFrame, text: str = "raw_payload") -> DataFrame:
    """Add the payload struct ``d``; the text stays for quarantine."""
    return raw.withColumn("d", F.from_json(F.col(text), PAYLOAD))


def parse_flat(raw: DataFrame, text: str = "value") -> DataFrame:
    return raw.select(F.from_json(F.col(text).cast("string"), PAYLOAD).alias("d")).select("d.*")


def is_valid() -> Column:
    """Null-free verdict, so that its negation keeps every other row."""
    return F.col("d.machine_id").isNotNull() & F.col("d.event_time").isNotNull()


def failure_reason() -> Column:
    """Malformed text parses to a struct of nulls, so it is told apart by its keys."""
    text = F.col("raw_payload")
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty payload")
        .when(F.json_object_keys(text).isNull(), "malformed JSON")
        .when(F.col("d.machine_id").isNull(), "machine_id is null")
        .when(F.col("d.event_time").isNull(), "event_time is null")
        .otherwise("unknown validation failure")
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) halves of one predicate; every row lands in exactly one."""
    return parsed.where(is_valid()), parsed.where(~is_valid())


def dead_letters(invalid: DataFrame, batch_id: str | int, quarantined_at: Column | None = None) -> DataFrame:
    return invalid.select(
        F.lit(str(batch_id)).alias("source_batch"),
        *ENVELOPE_COLUMNS.values(),
        "raw_payload",  # whole: the queue holds the only copy
        failure_reason().alias("failure_reason"),
        (F.current_timestamp() if quarantined_at is None else quarantined_at).alias("quarantined_at"),
        F.lit(None).cast("timestamp").alias("replayed_at"),
    )


def field_violations(parsed: DataFrame) -> DataFrame:
    """Rows kept as valid although a field of the wrong type was read as null. Only rows with a null field are parsed again."""
    some_null = reduce(Column.__or__, [F.col(f"d.{f.name}").isNull() for f in PAYLOAD.fields])
    keyed = parsed.where(is_valid() & some_null).withColumn(
        "_sent", F.from_json(F.col("raw_payload"), T.MapType(T.StringType(), T.StringType()))
    )
    bad = F.array_compact(
        F.array(
            *[
                F.when(F.col("_sent")[f.name].isNotNull() & F.col(f"d.{f.name}").isNull(), F.lit(f.name))
                for f in PAYLOAD.fields
            ]
        )
    )
    return (
        keyed.withColumn("bad_fields", bad)
        .where(F.size("bad_fields") > 0)
        .drop("_sent")
    )


COORDINATES = ["kafka_topic", "kafka_partition", "kafka_offset"]
OFFSET_BITS, TOPIC_BITS, PARTITION_BITS = 43, 4, 16


def message_id(topics: Sequence[str]) -> Column:
    """One number for (topic, partition, offset), in the order of offsets. No two messages of ``topics`` share one:
    what does not fit the bits, or another topic, is an error."""
    topic = F.array_position(F.array(*map(F.lit, topics)), F.col("kafka_topic")) - 1
    fits = (topic.between(0, (1 << TOPIC_BITS) - 1) & F.col("kafka_partition").between(0, (1 << PARTITION_BITS) - 1)
            & F.col("kafka_offset").between(0, (1 << OFFSET_BITS) - 1))
    packed = (F.shiftleft(F.col("kafka_offset"), TOPIC_BITS + PARTITION_BITS) + F.shiftleft(topic.cast("bigint"), PARTITION_BITS)
              + F.col("kafka_partition"))
    where = F.concat_ws(" ", F.lit("no number for message"), *COORDINATES)
    return F.when(fits, packed).otherwise(F.raise_error(where).cast("bigint"))


def not_seen(batch: DataFrame, offsets: DataFrame) -> DataFrame:
    """Messages of a batch, each once, without those that an earlier batch had.

    ``offsets`` is (kafka_topic, kafka_partition, next_offset): one row a partition, whatever the length of the stream. It rests on the
    broker's order: a partition hands out its offsets upwards. Unlike state behind a watermark it never takes a late message for a repeat.
    """
    seen = offsets.select(F.col("kafka_topic").alias("_topic"), F.col("kafka_partition").alias("_partition"), "next_offset")
    known = (F.col("kafka_topic") == F.col("_topic")) & (F.col("kafka_partition") == F.col("_partition"))
    return (batch.dropDuplicates(COORDINATES).join(small(seen), known, "left")
            .where(F.col("next_offset").isNull() | (F.col("kafka_offset") >= F.col("next_offset"))).drop("_topic", "_partition", "next_offset"))


def next_offsets(batch: DataFrame, offsets: DataFrame) -> DataFrame:
    newest = batch.select("kafka_topic", "kafka_partition", (F.col("kafka_offset") + 1).alias("next_offset"))
    return newest.unionByName(offsets).groupBy("kafka_topic", "kafka_partition").agg(F.max("next_offset").alias("next_offset"))


def keyed_messages(rows: DataFrame, key: str) -> DataFrame:
    """(key, value) pairs ready for a broker sink; value is the row as JSON."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*rows.columns), JSON_OPTIONS).alias("value"))
