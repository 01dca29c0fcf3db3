"""Batch plans over the driver's tables: ``(spark, sf_dir) -> DataFrame``.

Each plan composes the operators; Catalyst does pruning, pushdown and join
selection. Processing-time values of the reference (affinity computed_at,
serving ``now``) are derived from the data here, so results are repeatable:
``as_of`` is the newest event time (truncated to the second), ``now`` is the
newest arrival at the store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.config import (
    AFFINITY_PREFIX,
    CLICK_RATE,
    CONTENT_SLIDE_SECONDS,
    CONTENT_WINDOW_SECONDS,
    ENGAGEMENT_RATE,
    ISO_SECONDS,
    USER_WINDOW_SECONDS,
    WATERMARK_DELAY_SECONDS,
)
from eventide.functions.timefmt import iso_micros, iso_seconds
from eventide.operators import affinity as aff
from eventide.operators import late, serving, store
from eventide.operators import windows as win
from eventide.session import checkpoint_root, materialise
from eventide.sources import testdata
from eventide.sources.changelog import metadata_snapshot
from eventide.schemas import METRIC_RECORD
from eventide.sources.events_json import events_to_json, parse_events
from eventide.sources.logs import feature_log_from_messages, metric_log_from_messages
from eventide.streaming import latest


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.events(spark, sf_dir)


def events_shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference-shaped events with times as ISO text."""
    ev = events(spark, sf_dir)
    return ev.select(
        "event_id", "user_id", "content_id", "event_type", "dwell_time_ms",
        iso_micros("event_time").alias("event_time"),
        iso_micros("arrival_ts").alias("arrival_ts"),
    )


def as_of_time(ev: DataFrame) -> Column:
    """Newest event time, whole seconds, as a scalar subquery (a literal at run time)."""
    return ev.select(F.date_trunc("second", F.max("event_time"))).scalar()


def metadata_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata_snapshot(testdata.metadata_changelog(spark, sf_dir))


def user_hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.user_features(events(spark, sf_dir))


def content_sliding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.content_features(events(spark, sf_dir))


def content_sliding_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win.content_features_panes(events(spark, sf_dir))


def category_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return aff.affinity_features(ev, metadata_latest(spark, sf_dir), iso_seconds(as_of_time(ev)))


def category_affinity_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affinity through temp views + Spark SQL; computed_at is the same
    newest-event time, as a SQL scalar subquery over the events view."""
    ev = events(spark, sf_dir)
    as_of_sql = ("date_format(date_trunc('second', (SELECT max(event_time) FROM user_events_view)), "
                 "\"yyyy-MM-dd'T'HH:mm:ss'Z'\")")
    suffix = "_" + uuid.uuid4().hex
    as_of_sql = as_of_sql.replace("user_events_view", f"user_events_view{suffix}")
    return aff.affinity_features_sql(ev, metadata_latest(spark, sf_dir), as_of_sql, suffix)


def all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNION ALL of the three feature families (X1)."""
    ev = events(spark, sf_dir)
    affinity = aff.affinity_features(ev, metadata_latest(spark, sf_dir), iso_seconds(as_of_time(ev)))
    return win.window_features_one_pass(ev).unionByName(affinity)


def closed_windows_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return win.closed_only(win.window_features_one_pass(ev), ev)


# ---------------------------------------------------------------------------
# parsing (JSON round trip with the reference's lenient rules)
# ---------------------------------------------------------------------------
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def events_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    parsed = parse_events(testdata.events_json(ev), keep=["event_id"], fallback_time=as_of_time(ev))
    return parsed.select(
        "event_id", "user_id", "content_id", "event_type", "dwell_time_ms",
        F.date_format("event_time", ISO_MILLIS).alias("event_time"),
    )


# ---------------------------------------------------------------------------
# feature log and store
# ---------------------------------------------------------------------------
def feature_log_of(ev: DataFrame, snapshot: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Every feature record as the store receives it. A window record arrives
    when the watermark can first close it (window end + 30 s); affinity
    records arrive at ``as_of`` (default: the newest event time)."""
    if as_of is None:
        as_of = as_of_time(ev)
    affinity = store.with_log_columns(
        aff.affinity_features(ev, snapshot, iso_seconds(as_of)), F.unix_seconds(as_of))
    return window_log_of(ev).unionByName(affinity)


def window_log_of(ev: DataFrame) -> DataFrame:
    """Window-feature part of the log (arrival = window end + 30 s)."""
    return store.with_log_columns(
        win.window_features_one_pass(ev),
        F.unix_seconds(F.to_timestamp("computed_at", ISO_SECONDS)) + F.lit(WATERMARK_DELAY_SECONDS))


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_log_of(events(spark, sf_dir), metadata_latest(spark, sf_dir))


def feature_log_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.feature_kv(feature_log(spark, sf_dir))


def feature_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.latest_features(feature_log(spark, sf_dir)).drop("seq")


def metric_log_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric records through the sink's key and JSON value: the key beside what the value reads back as."""
    v = F.from_json(F.col("value"), METRIC_RECORD)
    return store.metric_kv(metric_log(spark, sf_dir)).select("key", v.alias("r")).select("key", "r.*")


def written_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The feature log and the metric log as tables of this query: what reads them several times makes them once."""
    ev = events(spark, sf_dir)
    log = materialise(feature_log_of(ev, metadata_latest(spark, sf_dir)), "feature_log")
    return log, materialise(late.metric_log(late.classify(ev), ev), "metric_log")


def serving_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both logs sent as messages and read back: accepted features, and the state
    with its last feature time taken from the log that was read."""
    messages = materialise(testdata.serving_messages(*written_logs(spark, sf_dir)), "messages")
    read = feature_log_from_messages(messages)
    state = serving.metric_state(metric_log_from_messages(messages), read)
    return state.select(read.select(F.count(F.lit(1))).scalar().alias("n_features"), "*")


def events_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as keyed messages and parsed again, summed by message key."""
    messages = events_to_json(events(spark, sf_dir))
    return parse_events(messages, keep=["key"]).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dwell_time_ms").alias("dwell_time_ms"),
        F.date_format(F.max("event_time"), ISO_MILLIS).alias("last_event_time"))


def changelog_rowkinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata changelog with explicit row kinds (first version inserted, later ones
    retracted and updated, some deleted), reduced to what an upsert consumer keeps."""
    log = testdata.metadata_changelog(spark, sf_dir)
    first = F.col("seq") < testdata.CONTENT_KEYS
    kinds = F.concat(F.when(first, F.array(F.lit("+I"))).otherwise(F.array(F.lit("-U"), F.lit("+U"))),
                     F.when(F.col("seq") % 10 == 0, F.array(F.lit("-D"))).otherwise(F.array().cast("array<string>")))
    return store.changelog_upserts(log.select(F.explode(kinds).alias("kind"), "content_id", "category", "seq"))


def entity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.entity_documents(store.latest_features(feature_log(spark, sf_dir)))


# ---------------------------------------------------------------------------
# late data
# ---------------------------------------------------------------------------
def classified(spark: SparkSession, sf_dir: str, *branches: str) -> DataFrame:
    return late.classify(events(spark, sf_dir), **({"branches": branches} if branches else {}))


def late_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.late_user_events(classified(spark, sf_dir, late.USER_BRANCH))


def late_content_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.late_content_events(classified(spark, sf_dir, late.CONTENT_BRANCH))


def late_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.late_metrics(classified(spark, sf_dir))


def watermark_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.watermark_samples(events(spark, sf_dir))


def late_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.late_share(classified(spark, sf_dir))


def batch_stream_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return late.divergence(ev, late.threshold_table(ev))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return late.metric_log(late.classify(ev), ev)


# ---------------------------------------------------------------------------
# serving
# ---------------------------------------------------------------------------
LOOKUP_ENTITY = " usr_2 "     # trimmed by the lookup, as the page does


def now_of(ev: DataFrame) -> Column:
    """Serving clock = the newest arrival at the store, i.e. the latest window
    end + 30 s (affinity arrives at ``as_of``, which is earlier). Derived from
    max(event_time) alone, a one-column scalar subquery, instead of
    recomputing the feature log."""
    us = F.unix_micros(F.max("event_time"))
    hour_end = (late.floor_div(us, USER_WINDOW_SECONDS * 1_000_000) + 1) * USER_WINDOW_SECONDS
    slide_end = late.floor_div(us, CONTENT_SLIDE_SECONDS * 1_000_000) * CONTENT_SLIDE_SECONDS + CONTENT_WINDOW_SECONDS
    return ev.select((F.greatest(hour_end, slide_end) + F.lit(WATERMARK_DELAY_SECONDS)).cast("double")).scalar()


def newest_window_end_ms(ev: DataFrame) -> Column:
    """Epoch ms of the newest window end. In the batch log window records
    arrive at end + 30 s, so this is the computed_at of the last written window
    feature (what ``serving.last_window_time`` reads from a log), derived from
    max(event_time) alone instead of recomputing every window."""
    us = F.unix_micros(F.max("event_time"))
    hour_end = (late.floor_div(us, USER_WINDOW_SECONDS * 1_000_000) + 1) * USER_WINDOW_SECONDS
    slide_end = late.floor_div(us, CONTENT_SLIDE_SECONDS * 1_000_000) * CONTENT_SLIDE_SECONDS + CONTENT_WINDOW_SECONDS
    return ev.select((F.greatest(hour_end, slide_end) * F.lit(1000)).cast("bigint")).scalar()


def metric_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return serving.metric_state(late.metric_log(late.classify(ev), ev), last_sim=newest_window_end_ms(ev))


def watermark_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.watermark_lag(metric_state(spark, sf_dir))


def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity's latest features. Only events that name the id are expanded
    into features; the filter stands below the expansion, at the scan."""
    ev = events(spark, sf_dir)
    key = F.trim(F.lit(LOOKUP_ENTITY))
    own = ev.filter((F.col("user_id") == key) | (F.col("content_id") == key))
    log = feature_log_of(own, metadata_latest(spark, sf_dir), as_of_time(ev))
    return serving.entity_lookup(store.latest_features(log.filter(F.col("entity_id") == key)), LOOKUP_ENTITY)


def stored_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup as a server does it: the log comes in two parts to the stream that keeps
    the latest values, and one id is read from the state of its last committed version."""
    root = f"{checkpoint_root(spark)}/tables/stored-{uuid.uuid4().hex}"
    log = materialise(feature_log(spark, sf_dir), "feature_log")
    affinity = F.col("feature_name").startswith(AFFINITY_PREFIX)
    for part in (log.filter(affinity), log.filter(~affinity)):
        part.write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
        latest.start_latest(stream, f"{root}/state", {"availableNow": True}).awaitTermination()
    return serving.entity_lookup(latest.read_latest(spark, f"{root}/state", LOOKUP_ENTITY), LOOKUP_ENTITY)


def entity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.entity_report(entity_lookup(spark, sf_dir), now_of(events(spark, sf_dir)))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest click rate is that of the newest event with a user, the newest engagement rate that of
    the newest with a content: two maxima in one scan, no window is computed."""
    us = lambda key: F.unix_micros(F.max(F.when(F.col(key).isNotNull() & (F.col(key) != ""), F.col("event_time"))))
    hour_end = (late.floor_div(us("user_id"), USER_WINDOW_SECONDS * 1_000_000) + 1) * USER_WINDOW_SECONDS
    last_end = (late.floor_div(us("content_id"), CONTENT_SLIDE_SECONDS * 1_000_000) * CONTENT_SLIDE_SECONDS
                + CONTENT_WINDOW_SECONDS)
    newest = events(spark, sf_dir).agg(*[(end + F.lit(WATERMARK_DELAY_SECONDS)).cast("double").alias(name)
                                         for name, end in ((CLICK_RATE, hour_end), (ENGAGEMENT_RATE, last_end))])
    return serving.freshness_of(newest, F.greatest(CLICK_RATE, ENGAGEMENT_RATE))


def recent_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.recent_updates(feature_log(spark, sf_dir))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.change_feed(*written_logs(spark, sf_dir))


def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    log = feature_log_of(ev, metadata_latest(spark, sf_dir))
    docs = store.entity_documents(store.latest_features(log))
    state = serving.metric_state(late.metric_log(late.classify(ev), ev), last_sim=newest_window_end_ms(ev))
    return serving.state_snapshot(docs, state)
