"""Serving reader: feature-store and metrics messages -> feature log, metric log.

Input is topic-shaped: (topic, key, value JSON, offset, arrival timestamp), as
read from the two topics together (``subscribe = "a,b"``) or from files.
Empty messages are skipped; feature records need an entity id and a name;
metric values become integers where the serving state keeps counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.schemas import FEATURE_RECORD, METRIC_RECORD


def serving_messages(reader, cfg, starting: str = "earliest") -> DataFrame:
    """Both topics of the serving reader in one subscription, from the start.

    ``reader`` is ``spark.read`` or ``spark.readStream``; split the messages with
    the two functions below."""
    topics = f"{cfg.feature_store_topic},{cfg.metrics_topic}"
    raw = reader.format("kafka").options(**{**cfg.kafka_reader_options(topics), "startingOffsets": starting}).load()
    return raw.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      "partition", "offset", F.col("timestamp").alias("arrival_ts"))


def _messages(raw: DataFrame, topic: str | None) -> DataFrame:
    ok = F.col("value").isNotNull() & (F.length("value") > 0)
    if topic is not None and "topic" in raw.columns:
        ok = ok & (F.col("topic") == topic)
    return raw.filter(ok)


def feature_log_from_messages(raw: DataFrame, topic: str | None = "feature-store") -> DataFrame:
    v = F.from_json(F.col("value"), FEATURE_RECORD)
    return (
        _messages(raw, topic)
        .select(v.alias("r"), F.col("offset").cast("bigint").alias("seq"),
                (F.unix_micros(F.col("arrival_ts")) / F.lit(1e6)).alias("received_at"))
        .select("r.*", "received_at", "seq")
        .filter(F.col("entity_id").isNotNull() & (F.col("entity_id") != "")
                & F.col("feature_name").isNotNull() & (F.col("feature_name") != ""))
    )


def metric_log_from_messages(raw: DataFrame, topic: str | None = "flink-metrics") -> DataFrame:
    v = F.from_json(F.col("value"), METRIC_RECORD)
    return (
        _messages(raw, topic)
        .select(v.alias("r"), F.col("offset").cast("bigint").alias("seq"))
        .select("r.*", "seq")
        .filter(F.col("metric_name").isNotNull())
    )
