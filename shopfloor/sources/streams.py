"""Event-stream sources and the bronze envelope.

``kafka_stream`` is the production source.  The Kafka connector is not part
of a plain PySpark install, so everything downstream only relies on the
Kafka record columns (key, value, topic, partition, offset, timestamp); a
folder of Parquet files with those columns (``record_file_stream``) stands in
for a topic in tests and in batch replays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.schemas import KAFKA_RECORD


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to one topic.  ``max_offsets_per_trigger`` bounds each
    micro-batch (the original ingest read everything in one trigger and wrote
    tens of thousands of small files)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def record_file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream Kafka-shaped records from files (declared schema, no inference)."""
    reader = spark.readStream.schema(KAFKA_RECORD).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def bronze_envelope(records: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Raw JSON plus transport metadata: the bronze row (schema-on-read)."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingestion_time is None else ingestion_time).alias("bronze_ingestion_time"),
    )


def replay_records(
    records: DataFrame,
    topic: str,
    partitions: int = 1,
    offset: Column | None = None,
) -> DataFrame:
    """Turn (key, value, event_ts[, line_number]) records into Kafka-shaped
    rows, as a broker would deliver them.

    Records of one key share a partition (keyed topic).  ``offset`` defaults
    to the record's ``line_number`` when present (its position in the
    source), else a hash of the record: a replay has no broker order, and a
    value computed from the row itself is the same when a task is retried
    (an id drawn from task-local row order would not be).
    """
    if offset is None:
        offset = (
            F.col("line_number")
            if "line_number" in records.columns
            else F.abs(F.xxhash64("key", "value", "event_ts"))
        )
    return records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.pmod(F.hash("key"), F.lit(partitions)) if partitions > 1 else F.lit(0)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.col("event_ts").alias("timestamp"),
    )


def events_topic(events: DataFrame, partitions: int = 4) -> DataFrame:
    """The ``events`` table as a keyed topic: key = user, value = the event as
    JSON, partition = user modulo ``partitions``, offset = event id, timestamp
    = event time."""
    from shopfloor.functions.json import to_json_record

    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        to_json_record("event_id", "ts", "user_id", "event_type", "value", "props").cast("binary").alias("value"),
        F.lit("web_events").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
