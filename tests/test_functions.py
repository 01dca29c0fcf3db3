"""Column functions: display texts, time parsing, floor division."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventide.functions.display import age_text, fixed4, lag_text, watermark_clock_text
from eventide.functions.timefmt import epoch_millis_of_iso, parse_event_time
from eventide.operators.late import floor_div


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_lag_text_rounding_and_sign(spark):
    cases = {(30_000, 0): "--", (0, 5): "--", (90_050, 60_000): "30.1s", (90_049, 60_000): "30.0s",
             (60_000, 90_000): "-30.0s", (1_000_000, 999_999): "0.0s"}
    for (last, wm), want in cases.items():
        assert _one(spark, lag_text(F.lit(last), F.lit(wm))) == want


def test_age_text_and_fixed4(spark):
    assert _one(spark, age_text(F.lit(None).cast("double"), F.lit(10.0))) == "--"
    assert _one(spark, age_text(F.lit(0.0), F.lit(10.0))) == "--"
    assert _one(spark, age_text(F.lit(9.5), F.lit(10.0))) == "Just now"
    assert _one(spark, age_text(F.lit(5.0), F.lit(10.9))) == "5s ago"
    assert _one(spark, fixed4(F.lit(1 / 3))) == "0.3333"
    assert _one(spark, fixed4(F.lit(None).cast("double"))) is None


def test_watermark_clock(spark):
    assert _one(spark, watermark_clock_text(F.lit(1767268770000))) == "11:59:30Z"
    assert _one(spark, watermark_clock_text(F.lit(0))) is None


def test_parse_event_time_precision_and_case(spark):
    fb = F.lit(dt.datetime(2030, 1, 1))
    got = _one(spark, parse_event_time(F.lit("2026-06-13t10:00:00.123456789z"), fb))
    assert got == dt.datetime(2026, 6, 13, 10, 0, 0, 123000)
    assert _one(spark, parse_event_time(F.lit(None).cast("string"), fb)) == dt.datetime(2030, 1, 1)
    assert _one(spark, epoch_millis_of_iso(F.lit("2026-01-01T12:00:00Z"))) == 1767268800000
    assert _one(spark, epoch_millis_of_iso(F.lit("junk"))) is None


def test_floor_div_is_exact_for_negative_values(spark):
    for v, n in [(-1, 300), (-300, 300), (299, 300), (1767268799999999, 300_000_000)]:
        assert _one(spark, floor_div(F.lit(v).cast("bigint"), n)) == v // n


def test_size_shuffle_partitions(spark):
    from eventide.plans import batch
    from eventide.session import size_shuffle_partitions
    from conftest import SF01

    ev = batch.events(spark, SF01)
    floor = spark.sparkContext.defaultParallelism
    assert size_shuffle_partitions(ev) == floor          # small input: the cluster's parallelism
    try:
        n = size_shuffle_partitions(ev, target_bytes=16 * 1024)
        assert n > floor
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(n)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_config_from_the_environment(monkeypatch):
    from eventide.config import PipelineConfig

    names = {"KAFKA_BOOTSTRAP_SERVERS": "bootstrap_servers", "KAFKA_TOPIC_USER_EVENTS": "user_events_topic",
             "KAFKA_TOPIC_CONTENT_METADATA": "content_metadata_topic", "KAFKA_TOPIC_FEATURE_STORE": "feature_store_topic",
             "KAFKA_TOPIC_METRICS": "metrics_topic"}
    for name in names:
        monkeypatch.delenv(name, raising=False)
    assert PipelineConfig.from_env() == PipelineConfig()
    for name in names:
        monkeypatch.setenv(name, name.lower())
    cfg = PipelineConfig.from_env()
    assert {field: getattr(cfg, field) for field in names.values()} == {f: n.lower() for n, f in names.items()}
    reader = cfg.kafka_reader_options(cfg.user_events_topic)
    assert reader["subscribe"] == "kafka_topic_user_events" and reader["startingOffsets"] == "earliest"
    assert reader["kafka.bootstrap.servers"] == cfg.kafka_writer_options("t")["kafka.bootstrap.servers"] == "kafka_bootstrap_servers"
    monkeypatch.setenv("KAFKA_TOPIC_METRICS", "")  # set to nothing: the default
    assert PipelineConfig.from_env().metrics_topic == PipelineConfig().metrics_topic
