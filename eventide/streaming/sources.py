"""Streaming sources: the event topic, the metadata changelog, file streams.

Kafka is the production source (the connector jar must be on the cluster's
classpath); JSON-lines file streams serve tests and file-based deployments.
Event sources yield a ``value`` string column, which the ingest parses, and
arrival columns; metadata sources yield changelog rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.config import PipelineConfig
from eventide.sources.changelog import parse_metadata_messages
from eventide.sources.events_json import drop_empty


def kafka_stream(spark: SparkSession, cfg: PipelineConfig, topic: str) -> DataFrame:
    """Raw topic stream: key/value as strings, partition, offset, timestamp."""
    raw = spark.readStream.format("kafka").options(**cfg.kafka_reader_options(topic)).load()
    return drop_empty(raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", F.col("timestamp").alias("arrival_ts"),
    ))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of ``value`` strings."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return drop_empty(reader.load(path)).select(F.col("value"), F.current_timestamp().alias("arrival_ts"))


def metadata_stream_kafka(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """The compacted metadata topic as a stream of changelog rows; a message without a value is a delete."""
    raw = spark.readStream.format("kafka").options(**cfg.kafka_reader_options(cfg.content_metadata_topic)).load()
    return parse_metadata_messages(raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "offset", "partition"))


def metadata_stream_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines metadata messages {key, value, offset[, partition]} as a stream of changelog rows."""
    reader = spark.readStream.schema("key string, value string, offset bigint, partition int")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_metadata_messages(reader.json(path))
