"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.plans import batch, streamed
from eventide.plans.oracle import SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "events_shaped": batch.events_shaped,
    "metadata_latest": batch.metadata_latest,
    "user_hourly_features": batch.user_hourly_features,
    "content_sliding_features": batch.content_sliding_features,
    "content_sliding_panes": batch.content_sliding_panes,
    "category_affinity": batch.category_affinity,
    "category_affinity_sql": batch.category_affinity_sql,
    "all_features": batch.all_features,
    "closed_windows_only": batch.closed_windows_only,
    "events_parsed": batch.events_parsed,
    "feature_log_kv": batch.feature_log_kv,
    "feature_store_latest": batch.feature_store_latest,
    "entity_documents": batch.entity_documents,
    "late_user_events": batch.late_user_events,
    "late_content_events": batch.late_content_events,
    "late_metrics": batch.late_metrics,
    "watermark_metrics": batch.watermark_metrics,
    "metric_log": batch.metric_log,
    "late_share": batch.late_share,
    "batch_stream_divergence": batch.batch_stream_divergence,
    "metric_state": batch.metric_state,
    "watermark_lag": batch.watermark_lag,
    "entity_lookup": batch.entity_lookup,
    "stored_lookup": batch.stored_lookup,
    "entity_report": batch.entity_report,
    "freshness": batch.freshness,
    "recent_updates": batch.recent_updates,
    "change_feed": batch.change_feed,
    "state_snapshot": batch.state_snapshot,
    "metric_log_kv": batch.metric_log_kv,
    "serving_reader": batch.serving_reader,
    "events_published": batch.events_published,
    "changelog_rowkinds": batch.changelog_rowkinds,
    "streamed_windows": streamed.streamed_windows,
    "streamed_windows_sql": streamed.streamed_windows_sql,
    "streamed_late_metrics": streamed.streamed_late_metrics,
    "streamed_divergence": streamed.streamed_divergence,
    "streamed_affinity": streamed.streamed_affinity,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in SQL.items() if name in QUERIES}
