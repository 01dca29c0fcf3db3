"""The streaming job over the driver's tables, as queries that end.

Events are published as JSON messages and the metadata changelog as upsert
messages, in the pieces in which they arrive; after each piece the job's own
queries run until everything has come through (``availableNow``), each from its
checkpoint. All tables and checkpoints are new folders below the shared one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.late import compare_feature_sets_stream
from eventide.operators import windows as win
from eventide.schemas import FEATURE_COLUMNS, FEATURE_RECORD
from eventide.session import checkpoint_root
from eventide.sources import testdata
from eventide.sources.changelog import metadata_to_messages
from eventide.sources.events_json import events_to_json, publish_files
from eventide.streaming import queries as q
from eventide.streaming.affinity import start_affinity, start_moves
from eventide.streaming.ingest import event_table, start_ingest
from eventide.streaming.sources import file_stream, metadata_stream_files
from eventide.streaming.tables import Layout, prepare_streaming, table_stream

NOW = {"availableNow": True}
#: Pieces in which the events arrive.
PIECES = 3


def _layout(spark: SparkSession) -> Layout:
    return Layout(f"{checkpoint_root(spark)}/tables/streamed-{uuid.uuid4().hex}")


def _arrive(spark: SparkSession, events: DataFrame, layout: Layout) -> None:
    """Publish events and take them in."""
    publish_files(events_to_json(events), f"{layout.root}/messages")
    start_ingest(file_stream(spark, f"{layout.root}/messages"), layout, checkpoint=f"{layout.root}/ck-ingest",
                 trigger=NOW).awaitTermination()


def _piece(events: DataFrame) -> Column:
    """Which equal part of the arrivals' time span an event comes in; the late ones come one part later still."""
    span = events.select(F.struct(F.unix_micros(F.min("arrival_ts")).alias("a"), F.unix_micros(F.max("arrival_ts")).alias("b"))).scalar()
    at = (F.unix_micros("arrival_ts") - span["a"]) * PIECES
    late = (F.col("event_id") % testdata.LATE_EVERY == 0).cast("int")
    return F.least(F.floor(at / (span["b"] - span["a"] + 1)).cast("int") + late, F.lit(PIECES - 1))


def _windows_in_pieces(spark: SparkSession, sf_dir: str) -> tuple[Layout, DataFrame]:
    """The window query run after each piece of the arrivals."""
    layout, events = _layout(spark), testdata.events(spark, sf_dir)
    numbered = events.withColumn("piece", _piece(events))
    for piece in range(PIECES):
        _arrive(spark, numbered.filter(F.col("piece") == piece).drop("piece"), layout)
        q.start_window_features(event_table(spark, layout), layout, checkpoint=f"{layout.root}/ck-windows",
                                trigger=NOW).awaitTermination()
    return layout, events


def streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one piece through ingest and windows: what the last watermark has closed."""
    layout = _layout(spark)
    _arrive(spark, testdata.events(spark, sf_dir), layout)
    q.start_window_features(event_table(spark, layout), layout, checkpoint=f"{layout.root}/ck-windows",
                            trigger=NOW).awaitTermination()
    return q.feature_log(spark, layout).select(*FEATURE_COLUMNS)


def streamed_windows_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through Spark SQL over a temporary view of the stream."""
    layout = _layout(spark)
    _arrive(spark, testdata.events(spark, sf_dir), layout)
    prepare_streaming(spark)
    rows = win.window_features_sql(event_table(spark, layout), view_suffix="_" + uuid.uuid4().hex)
    (rows.writeStream.format("parquet").outputMode("append").option("path", layout.features)
     .option("checkpointLocation", f"{layout.root}/ck-sql").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(FEATURE_RECORD).parquet(layout.features)


def streamed_late_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three pieces: late records by branch, against the watermark of the piece that brought them."""
    layout, _ = _windows_in_pieces(spark, sf_dir)
    late = q.metric_log(spark, layout).filter("metric_name = 'late_events_dropped'")
    return late.groupBy("branch").agg(F.sum("metric_value").cast("bigint").alias("late_events"))


def streamed_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream emitted from three pieces, joined as a stream with the recomputed features:
    windows that differ, and those that only one side has once the watermark is past them."""
    layout, events = _windows_in_pieces(spark, sf_dir)
    win.window_features_one_pass(events).write.parquet(f"{layout.root}/recomputed")
    emitted = table_stream(spark, layout.features, FEATURE_RECORD)
    recomputed = table_stream(spark, f"{layout.root}/recomputed", FEATURE_RECORD)
    prepare_streaming(spark)
    (compare_feature_sets_stream(recomputed, emitted).writeStream.format("parquet").outputMode("append")
     .option("path", f"{layout.root}/divergence").option("checkpointLocation", f"{layout.root}/ck-divergence")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{layout.root}/divergence")


def streamed_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and changelog in two interleaved halves through keyed state: the last total of each (user, category).

    Totals that fell to zero are emitted and left out here."""
    layout = _layout(spark)
    events, changes = testdata.events(spark, sf_dir), testdata.metadata_changelog(spark, sf_dir)
    messages = metadata_to_messages(changes)
    runs: list[Callable] = [
        lambda: start_moves(event_table(spark, layout, watermark=False), metadata_stream_files(spark, f"{layout.root}/changes"),
                            layout, checkpoint=f"{layout.root}/ck-moves", trigger=NOW),
        lambda: start_affinity(spark, layout, checkpoint=f"{layout.root}/ck-totals", trigger=NOW, emit_zero=True),
    ]
    for half in range(2):
        (messages.filter(F.pmod("offset", F.lit(2)) == half).select(F.to_json(F.struct("key", "value", "offset")).alias("value"))
         .write.mode("append").text(f"{layout.root}/changes"))
        _arrive(spark, events.filter(F.pmod("event_id", F.lit(2)) == half), layout)
        for run in runs:
            run().awaitTermination()
    latest = q.feature_log(spark, layout).groupBy("entity_id", "feature_name").agg(
        F.max_by("feature_value", "seq").alias("feature_value"))
    return latest.filter("feature_value > 0")
