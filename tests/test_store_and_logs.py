"""Latest values as state and as a table, changelog row kinds, topic-shaped serving input."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.operators import serving, store
from eventide.sources.logs import feature_log_from_messages, metric_log_from_messages
from conftest import rows

LOG = "entity_id string, feature_name string, feature_value double, computed_at string, received_at double, seq bigint"


def test_latest_values_as_state(spark, tmp_path):
    """The log comes in parts; every committed version can be read, of one entity or all."""
    from eventide.streaming.latest import read_latest, start_latest

    log, state = str(tmp_path / "log"), str(tmp_path / "state")

    def add(*records):
        spark.createDataFrame(records, LOG).write.mode("append").parquet(log)
        start_latest(spark.readStream.schema(LOG).parquet(log), state, {"availableNow": True}).awaitTermination()

    add(("u1", "click_rate", 0.2, "t1", 1.0, 0), ("u2", "click_rate", 0.4, "t1", 1.0, 0), ("", "x", 1.0, "t", 1.0, 0),
        (None, "x", 1.0, "t", 1.0, 0), ("u3", "", 1.0, "t", 1.0, 0))
    add(("u1", "click_rate", 0.5, "t2", 2.0, 1), ("u1", "avg_dwell_time", None, None, 2.0, 1))
    add(("u1", "click_rate", 0.2, "t1", 1.0, 0))  # an old record once more
    assert rows(read_latest(spark, state), "entity_id", "feature_name", "feature_value", "computed_at", "seq") == [
        ("u1", "avg_dwell_time", None, None, 1), ("u1", "click_rate", 0.5, "t2", 1), ("u2", "click_rate", 0.4, "t1", 0)]
    assert rows(read_latest(spark, state, " u2 "), "entity_id") == [("u2",)]
    assert rows(read_latest(spark, state, version=0), "entity_id", "feature_value") == [("u1", 0.2), ("u2", 0.4)]
    assert read_latest(spark, state, "nobody").count() == 0
    with pytest.raises(Exception, match="none"):
        read_latest(spark, str(tmp_path / "none"))


def test_written_latest_table(spark, tmp_path):
    path = str(tmp_path / "latest")
    log = spark.createDataFrame([("u1", "click_rate", 0.2, "t1", 1.0, 0), ("u1", "click_rate", 0.5, "t2", 2.0, 1),
                                 ("u2", "click_rate", 0.4, "t1", 1.0, 0)], LOG)
    store.write_latest(log, path)
    assert rows(spark.read.parquet(path), "entity_id", "feature_value") == [("u1", 0.5), ("u2", 0.4)]


def test_changelog_upserts_keep_inserts_and_update_after(spark):
    df = spark.createDataFrame([("+I", 1), ("-U", 1), ("+U", 2), ("-D", 2)], "kind string, v int")
    assert rows(store.changelog_upserts(df), "v") == [(1,), (2,)]


def test_serving_reader_from_messages(spark):
    ts = dt.datetime(2026, 1, 1, 0, 0, 10)
    raw = spark.createDataFrame(
        [("feature-store", "u1:click_rate",
          '{"entity_id":"u1","feature_name":"click_rate","feature_value":0.5,"computed_at":"2026-01-01T12:00:00Z"}', 7, ts),
         ("feature-store", "x", "", 8, ts),
         ("feature-store", "x", '{"entity_id":"","feature_name":"click_rate","feature_value":1.0}', 9, ts),
         ("flink-metrics", "late_events_dropped",
          '{"metric_name":"late_events_dropped","metric_value":1.0,"computed_at":"x"}', 1, ts),
         ("flink-metrics", "current_watermark",
          '{"metric_name":"current_watermark","metric_value":1767268770000.0,"computed_at":"y"}', 2, ts)],
        "topic string, key string, value string, offset bigint, arrival_ts timestamp")
    log = feature_log_from_messages(raw)
    assert rows(log, "entity_id", "feature_value", "seq") == [("u1", 0.5, 7)]
    metrics = metric_log_from_messages(raw)
    state = serving.metric_state(metrics, log).first()
    assert (state.late_events_dropped, state.current_watermark) == (1, 1767268770000)
    assert state.last_sim_time == 1767268800000


def test_publication_round_trips(spark, tmp_path):
    from pyspark.sql import functions as F

    from eventide.sources.changelog import metadata_snapshot, metadata_to_messages, parse_metadata_messages
    from eventide.sources.events_json import events_to_json, parse_events, publish_files

    ev = spark.createDataFrame(
        [("u1", "c1", "view", 10, dt.datetime(2026, 1, 1, 10, 0, 0, 123000)),
         ("u2", "c2", "click", 0, dt.datetime(2026, 1, 1, 11, 0))],
        "user_id string, content_id string, event_type string, dwell_time_ms bigint, event_time timestamp")
    back = parse_events(events_to_json(ev), fallback_time=F.lit(None).cast("timestamp"))
    assert rows(back) == rows(ev)

    path = str(tmp_path / "published")
    publish_files(events_to_json(ev), path, partitions=2)
    assert sorted(spark.read.text(path).collect()) == sorted(events_to_json(ev).select("value").collect())

    meta = spark.createDataFrame(
        [("c1", "News", "k1", None, 1, False), ("c1", "Tech", "k1", None, 2, False), ("c2", "Art", None, None, 3, False),
         ("c2", None, None, None, 4, True)],
        "content_id string, category string, creator_id string, publish_timestamp string, seq bigint, deleted boolean")
    again = parse_metadata_messages(metadata_to_messages(meta))
    assert rows(metadata_snapshot(again), "content_id", "category", "seq") == [("c1", "Tech", 2)]


def test_batch_folder_helpers_on_edges(spark, tmp_path):
    from eventide.streaming.sinks import read_batches, read_previous, read_table, write_batch

    table = str(tmp_path / "t")
    assert read_table(spark, table) is None
    assert read_batches(spark, table, [0, 1]) is None
    for b in (0, 2, 3):
        write_batch(spark.createDataFrame([(b,)], "x int"), table, b)
    write_batch(spark.createDataFrame([(3,)], "x int"), table, 3)  # a replay
    assert read_previous(spark, table, 2).count() == 1          # batch 1 missing: falls back to <= 1
    assert sorted(r.x for r in read_batches(spark, table, [1, 2, 3]).collect()) == [2, 3]
    assert sorted(r.x for r in read_table(spark, table).collect()) == [0, 2, 3]
    assert sorted(r.x for r in read_table(spark, table, upto_batch=2).collect()) == [0, 2]


def test_recent_updates_open_only_the_newest_batches(spark, tmp_path):
    from eventide.streaming import queries as q
    from eventide.streaming.sinks import batch_ids, write_batch

    layout = q.Layout(str(tmp_path / "out"))
    assert q.recent_log(spark, layout) is None and batch_ids(spark, layout.features) == []
    for b in range(12):  # batches of 0 to 11 rows; affinity lags behind
        write_batch(spark.createDataFrame([(f"u{b}", f"f{i}", float(i), "t", 100.0 + b, b) for i in range(b)], LOG), layout.features, b)
    for b in range(3):
        write_batch(spark.createDataFrame([(f"a{b}", f"g{i}", float(i), "t", 99.5 + 4 * b, b) for i in range(2)], LOG), layout.affinity, b)
    assert batch_ids(spark, layout.features) == list(range(12))
    for n in (1, 11, 12, 40, 500):
        part = q.recent_log(spark, layout, n)
        want = serving.recent_updates(q.feature_log(spark, layout), n).collect()
        assert serving.recent_updates(part, n).collect() == want and len(want) == min(n, 72)
    read = {int(f.rpartition("batch_id=")[2].partition("/")[0]) for f in q.recent_log(spark, layout, 11).inputFiles() if "/features/" in f}
    assert read == {11}
