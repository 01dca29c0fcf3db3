"""The queries of the streaming job.

* ``ingest`` (:mod:`eventide.streaming.ingest`) reads and parses the topic once.
* ``window_features`` (append): user hourly and content sliding windows under a
  30 s watermark; a window is emitted once, when the watermark passes its end;
  rows behind the watermark are dropped by Spark's stateful operators. The same
  query lets the batch's events through beside the windows, so the late ones
  are found in the very batches, and against the watermark, in which the windows drop them,
  however the stream was cut. They become ``late_events_dropped`` records.
* ``category_moves`` and ``category_affinity`` (:mod:`eventide.streaming.affinity`).
* ``latest_features`` (:mod:`eventide.streaming.latest`), on request.

Outputs by batch go through idempotent ``foreachBatch`` writers keyed by batchId,
so a replay after an executor or driver failure overwrites, never duplicates.
Checkpoints live under the cluster's ``spark.checkpoint.dir`` unless a
location is given.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.config import (
    AVG_DWELL_TIME,
    CLICK_RATE,
    CONTENT_SLIDE_SECONDS,
    CONTENT_WINDOW_SECONDS,
    ENGAGEMENT_RATE,
    FEED_METRICS_UPDATE,
    METRIC_CURRENT_WATERMARK,
    METRIC_LATE_EVENTS_DROPPED,
    RECENT_UPDATES_CAP,
    USER_WINDOW_SECONDS,
    WATERMARK_DELAY_SECONDS,
    WATERMARK_METRIC_PERIOD_MS,
)
from eventide.functions.timefmt import epoch_millis_of_iso, iso_micros
from eventide.operators import windows as win
from eventide.operators.late import CONTENT_BRANCH, USER_BRANCH, floor_div
from eventide.operators.serving import feature_update, freshness_of
from eventide.schemas import FEATURE_COLUMNS, FEATURE_LOG, METRIC_RECORD
from eventide.streaming.sinks import newest_batches, read_previous, read_table, write_batch
from eventide.streaming.tables import Layout, checkpoint_of, log_rows, prepare_streaming, started_with, table_stream

__all__ = ["Layout", "change_feed_stream", "feature_log", "feature_log_stream", "metric_log", "metric_state_stream", "metrics_feed_stream",
           "observed_freshness", "prepare_streaming", "recent_log", "serving_state", "start_window_features"]

MICROS = 1_000_000
WINDOW_FEATURES = (CLICK_RATE, AVG_DWELL_TIME, ENGAGEMENT_RATE)
#: One row a batch of the window query, observed while its records were written.
CLOCK = ("newest_ms bigint, recorded_ms bigint, watermark_ms bigint, sampled_ms bigint, late_events bigint, last_window_ms bigint, "
         "written_at double, " + ", ".join(f"{name} bigint" for name in WINDOW_FEATURES))
METRIC_ROWS = T.StructType(METRIC_RECORD.fields + [T.StructField("branch", T.StringType()), T.StructField("seq", T.LongType())])


# ---------------------------------------------------------------------------
# windows and what comes too late for them
# ---------------------------------------------------------------------------
def _with_events(events: DataFrame) -> DataFrame:
    """The window features, and beside them each event's time and which branches take it."""
    features = win.window_features(events)
    own = {"event_time": F.col("event_time"), "has_user": F.col("user_id").isNotNull(), "has_content": F.col("content_id").isNotNull()}
    kinds = dict(features.dtypes)
    blank = [F.lit(None).cast(kinds[c]).alias(c) for c in FEATURE_COLUMNS]
    passing = events.select(*blank, *[c.alias(name) for name, c in own.items()])
    return features.select(*FEATURE_COLUMNS, F.lit(None).cast("timestamp").alias("event_time"),
                           F.lit(None).cast("boolean").alias("has_user"), F.lit(None).cast("boolean").alias("has_content")
                           ).unionByName(passing)


def _late_for(watermark_ms: int | None) -> tuple:
    """Conditions: the event's user hour, and the last of its content windows, ended at or before the watermark."""
    us = F.unix_micros(F.col("event_time"))
    hour_end = (floor_div(us, USER_WINDOW_SECONDS * MICROS) + 1) * F.lit(USER_WINDOW_SECONDS * MICROS)
    last_end = floor_div(us, CONTENT_SLIDE_SECONDS * MICROS) * F.lit(CONTENT_SLIDE_SECONDS * MICROS) + F.lit(CONTENT_WINDOW_SECONDS * MICROS)
    if watermark_ms is None:
        return F.lit(False), F.lit(False)
    limit = F.lit(watermark_ms * 1000).cast("bigint")
    return (F.coalesce(F.col("has_user") & (hour_end <= limit), F.lit(False)),
            F.coalesce(F.col("has_content") & (last_end <= limit), F.lit(False)))


def start_window_features(events: DataFrame, layout: Layout, checkpoint: str | None = None,
                          trigger: dict | None = None, sink: Callable[[DataFrame], None] | None = None,
                          metric_sink: Callable[[DataFrame], None] | None = None,
                          name: str = "window_features") -> StreamingQuery:
    """``events`` must carry the 30 s watermark (see ``event_table``).

    A batch's watermark is the newest event time of the batches before it less
    the delay, in milliseconds, as Spark has it; the newest time is observed
    while the batch is written and kept beside it, so a restart goes on from
    there. With it are kept the numbers that the serving state needs (see
    :func:`serving_state`). ``current_watermark`` is recorded at most once per 5 s.
    """
    spark = events.sparkSession
    prepare_streaming(spark)

    def write(df: DataFrame, batch_id: int) -> None:
        session, now = df.sparkSession, int(time.time() * 1000)
        before = read_previous(session, layout.clock, batch_id)
        newest, recorded = (before.agg(F.max("newest_ms"), F.max("recorded_ms")).first() if before is not None else (None, None))
        watermark = None if newest is None else newest - WATERMARK_DELAY_SECONDS * 1000
        late_user, late_content = _late_for(watermark)
        seen, is_feature = Observation(), F.col("entity_id").isNotNull()
        kept = (df.withColumn("late_user", late_user).withColumn("late_content", late_content)
                .observe(seen, F.max(F.unix_millis("event_time")).alias("newest_ms"),
                         (F.count_if("late_user") + F.count_if("late_content")).alias("late_events"),
                         F.max(epoch_millis_of_iso(F.col("computed_at"))).alias("last_window_ms"),
                         *[F.count_if(F.col("feature_name") == name).alias(name) for name in WINDOW_FEATURES])
                .filter(is_feature | F.col("late_user") | F.col("late_content")).persist())
        due = watermark is not None and (recorded is None or now - recorded > WATERMARK_METRIC_PERIOD_MS)
        try:
            write_batch(log_rows(kept.filter(is_feature), batch_id, now), layout.features, batch_id)
            metrics = _metrics(kept, watermark if due else None, now)
            write_batch(metrics.withColumn("seq", F.lit(batch_id).cast("bigint")), layout.metrics, batch_id)
        finally:
            kept.unpersist()
        got = seen.get
        row = (max((x for x in (newest, got["newest_ms"]) if x is not None), default=None), now if due else recorded, watermark,
               watermark if due else None, got["late_events"], got["last_window_ms"], now / 1000, *[got[name] for name in WINDOW_FEATURES])
        write_batch(session.createDataFrame([row], CLOCK), layout.clock, batch_id)
        for target, table, schema in ((sink, layout.features, FEATURE_LOG), (metric_sink, layout.metrics, METRIC_ROWS)):
            if target is not None:  # the rows as written, not a second evaluation with other times
                target(session.read.schema(schema).parquet(f"{table}/batch_id={batch_id}"))

    writer = (_with_events(events).writeStream.outputMode("append").foreachBatch(write).queryName(name)
              .option("checkpointLocation", checkpoint_of(spark, name, checkpoint, layout)))
    # the watermark is that of all events, as at the source, also for the branches that skip rows without a key
    return started_with(spark, "spark.sql.streaming.multipleWatermarkPolicy", "max", writer, trigger)


def _metrics(kept: DataFrame, watermark_ms: int | None, now_ms: int) -> DataFrame:
    """A record for every late event and branch, and the watermark's where it is due."""
    now = iso_micros(F.timestamp_millis(F.lit(now_ms)))
    branches = F.array_compact(F.array(F.when(F.col("late_user"), F.lit(USER_BRANCH)), F.when(F.col("late_content"), F.lit(CONTENT_BRANCH))))
    late = kept.select(F.lit(METRIC_LATE_EVENTS_DROPPED).alias("metric_name"), F.lit(1.0).alias("metric_value"),
                       now.alias("computed_at"), F.explode(branches).alias("branch"))
    if watermark_ms is None:
        return late
    sample = kept.sparkSession.range(1).select(
        F.lit(METRIC_CURRENT_WATERMARK).alias("metric_name"), F.lit(float(watermark_ms)).alias("metric_value"),
        now.alias("computed_at"), F.lit(None).cast("string").alias("branch"))
    return late.unionByName(sample)


# ---------------------------------------------------------------------------
# serving reads of the job's output
# ---------------------------------------------------------------------------
def feature_log(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Window and affinity records as one log (seq = batch id)."""
    parts = [t for t in (read_table(spark, layout.features), read_table(spark, layout.affinity)) if t is not None]
    if not parts:
        return None
    log = parts[0].drop("batch_id")
    for p in parts[1:]:
        log = log.unionByName(p.drop("batch_id"))
    return log


def recent_log(spark: SparkSession, layout: Layout, n: int = RECENT_UPDATES_CAP) -> DataFrame | None:
    """A part of the log that surely holds its newest ``n`` arrivals (see ``serving.recent_updates``).

    A table's records arrive in order of their batches, so from each table the newest batches with ``n`` rows are enough."""
    parts = [t for t in (newest_batches(spark, table, n) for table in (layout.features, layout.affinity)) if t is not None]
    if not parts:
        return None
    log = parts[0].drop("batch_id")
    for p in parts[1:]:
        log = log.unionByName(p.drop("batch_id"))
    return log


def metric_log(spark: SparkSession, layout: Layout) -> DataFrame | None:
    m = read_table(spark, layout.metrics)
    return None if m is None else m.drop("batch_id")


def serving_state(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """The state of ``serving.metric_state`` from what was observed while the logs were written: one row a batch, no log is read."""
    clock = read_table(spark, layout.clock)
    if clock is None:
        return None
    zero = F.lit(0).cast("bigint")
    return clock.agg(F.coalesce(F.sum("late_events"), zero).alias("late_events_dropped"),
                     F.coalesce(F.max_by("sampled_ms", F.when(F.col("sampled_ms").isNotNull(), F.col("batch_id"))), zero).alias("current_watermark"),
                     F.coalesce(F.max("last_window_ms"), zero).alias("last_sim_time"))


def observed_freshness(spark: SparkSession, layout: Layout, now_seconds: Column) -> DataFrame | None:
    """``serving.freshness`` from the same rows: when a batch with records of the name was written last."""
    clock = read_table(spark, layout.clock)
    if clock is None:
        return None
    newest = clock.agg(*[F.max(F.when(F.col(n) > 0, F.col("written_at"))).alias(n) for n in (CLICK_RATE, ENGAGEMENT_RATE)])
    return freshness_of(newest, now_seconds)


def feature_log_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    """Window and affinity records as one stream."""
    return table_stream(spark, layout.features, FEATURE_LOG).unionByName(table_stream(spark, layout.affinity, FEATURE_LOG))


def change_feed_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    """Window and affinity records as one stream of ``feature_update`` JSON messages."""
    log = feature_log_stream(spark, layout)
    return log.select(feature_update(log).alias("message"))


def metric_state_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    """Running serving state over the metric and feature tables as a stream (use
    ``outputMode("complete")`` or ``"update"``): total late drops, newest
    watermark sample, newest window feature time. One global partial aggregation."""
    number = F.col("metric_value").cast("bigint")
    none = F.lit(None).cast("bigint")
    metrics = table_stream(spark, layout.metrics, METRIC_ROWS).select(
        F.when(F.col("metric_name") == METRIC_LATE_EVENTS_DROPPED, number).alias("late"),
        F.when(F.col("metric_name") == METRIC_CURRENT_WATERMARK, number).alias("wm"), none.alias("sim"))
    windows = table_stream(spark, layout.features, FEATURE_LOG).select(
        none.alias("late"), none.alias("wm"), epoch_millis_of_iso(F.col("computed_at")).alias("sim"))
    zero = F.lit(0).cast("bigint")
    return metrics.unionByName(windows).agg(
        F.coalesce(F.sum("late"), zero).alias("late_events_dropped"),
        F.coalesce(F.max("wm"), zero).alias("current_watermark"),
        F.coalesce(F.max("sim"), zero).alias("last_sim_time"))


def metrics_feed_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    """``metrics_update`` JSON messages: the state after each micro-batch (``outputMode("update")``)."""
    state = metric_state_stream(spark, layout)
    return state.select(F.to_json(F.struct(F.lit(FEED_METRICS_UPDATE).alias("type"), *state.columns)).alias("message"))
