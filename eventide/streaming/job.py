"""Launch the whole streaming job: ingest, windows, affinity, optional latest
values and Kafka sinks.

    python -m eventide.streaming.job --out /shared/features \\
        --events-dir /shared/in/events --metadata-dir /shared/in/metadata
    python -m eventide.streaming.job --out /shared/features --kafka   # topics from the environment
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventide.config import PipelineConfig
from eventide.schemas import FEATURE_COLUMNS, METRIC_COLUMNS
from eventide.streaming import queries as q
from eventide.streaming.affinity import start_affinity, start_moves
from eventide.streaming.ingest import event_table, start_ingest
from eventide.streaming.latest import latest_checkpoint, start_latest
from eventide.streaming.listener import WatermarkMetricListener
from eventide.streaming.sinks import kafka_features, kafka_metrics
from eventide.streaming.sources import file_stream, kafka_stream, metadata_stream_files, metadata_stream_kafka
from eventide.streaming.tables import Layout


@dataclass
class Job:
    """The running queries, and how to start those that follow them.

    With a trigger that ends by itself (``availableNow``) a query sees what is
    there when it starts, so each stage starts when the one it reads has ended.
    """

    spark: SparkSession
    layout: Layout
    listener: WatermarkMetricListener
    later: list[list[Callable[[], StreamingQuery]]]
    queries: list[StreamingQuery] = field(default_factory=list)

    def start_next(self) -> None:
        self.queries += [start() for start in self.later.pop(0)]

    def drain(self) -> None:
        """Until all that the sources have has come through."""
        while True:
            for query in self.queries:
                query.processAllAvailable()
            if not self.later:
                return
            self.start_next()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()
        self.spark.streams.removeListener(self.listener)


def start_job(spark: SparkSession, raw: DataFrame, changes: DataFrame, root: str, trigger: dict | None = None,
              mode: str = "FAILFAST", emit_zero: bool = False, latest: bool = False,
              kafka: PipelineConfig | None = None, files_per_batch: int | None = None) -> Job:
    """``raw`` are the event messages, ``changes`` the metadata changelog, both streams.

    ``latest`` keeps the latest value of every feature as state. In PERMISSIVE
    mode malformed messages are kept apart (``ingest.quarantine``).
    ``files_per_batch`` bounds what the readers of the event table take at once.
    """
    layout = Layout(root.rstrip("/"))
    # observation only: the window query alone records watermarks
    listener = WatermarkMetricListener("window_features")
    spark.streams.addListener(listener)
    features = (lambda rows: kafka_features(rows.select(*FEATURE_COLUMNS), kafka)) if kafka is not None else None
    metrics = (lambda rows: kafka_metrics(rows.select(*METRIC_COLUMNS), kafka)) if kafka is not None else None

    stages: list[list[Callable[[], StreamingQuery]]] = [
        [lambda: start_ingest(raw, layout, mode, trigger=trigger)],
        [lambda: q.start_window_features(event_table(spark, layout, files_per_batch=files_per_batch), layout, trigger=trigger,
                                         sink=features, metric_sink=metrics),
         lambda: start_moves(event_table(spark, layout, watermark=False, files_per_batch=files_per_batch), changes, layout,
                             trigger=trigger)],
        [lambda: start_affinity(spark, layout, trigger=trigger, emit_zero=emit_zero, sink=features)],
    ]
    if latest:
        stages.append([lambda: start_latest(q.feature_log_stream(spark, layout), latest_checkpoint(spark, layout), trigger)])
    job = Job(spark, layout, listener, stages)
    job.start_next()
    while job.later and "availableNow" not in (trigger or {}):
        job.start_next()
    return job


def main(argv: list[str] | None = None) -> None:
    from eventide.session import prepare

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--out", required=True, help="shared folder for the job's tables")
    ap.add_argument("--events-dir")
    ap.add_argument("--metadata-dir")
    ap.add_argument("--kafka", action="store_true")
    ap.add_argument("--latest", action="store_true", help="keep the latest value of every feature as state")
    ap.add_argument("--permissive", action="store_true", help="quarantine malformed JSON instead of failing")
    ap.add_argument("--emit-zero", action="store_true")
    args = ap.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("eventide-stream").getOrCreate())
    cfg = PipelineConfig.from_env()
    if args.kafka:
        raw = kafka_stream(spark, cfg, cfg.user_events_topic)
        changes = metadata_stream_kafka(spark, cfg)
    else:
        raw = file_stream(spark, args.events_dir)
        changes = metadata_stream_files(spark, args.metadata_dir)
    job = start_job(spark, raw, changes, args.out, mode="PERMISSIVE" if args.permissive else "FAILFAST",
                    emit_zero=args.emit_zero, latest=args.latest, kafka=cfg if args.kafka else None)
    spark.streams.awaitAnyTermination()
    job.stop()


if __name__ == "__main__":
    main()
