"""Feature log and latest-value feature store.

The reference keeps features in a compacted log keyed ``entity_id:feature_name``.
Here the log is an append-only table (record + ``received_at`` + ``seq``), and
the store is its latest row per key: ``max_by`` over a struct ordered by
(seq, received_at, computed_at). That is a partial aggregation, so a hot entity
never gathers its whole history in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.schemas import FEATURE_COLUMNS, METRIC_COLUMNS


def with_log_columns(features: DataFrame, received_at: Column, seq: Column | None = None) -> DataFrame:
    return features.select(
        *FEATURE_COLUMNS,
        received_at.cast("double").alias("received_at"),
        (seq if seq is not None else F.lit(0)).cast("bigint").alias("seq"),
    )


def store_key(entity_id: Column | str = "entity_id", feature_name: Column | str = "feature_name") -> Column:
    """Compaction key ``entity_id:feature_name``."""
    e = F.col(entity_id) if isinstance(entity_id, str) else entity_id
    f = F.col(feature_name) if isinstance(feature_name, str) else feature_name
    return F.concat_ws(":", e, f)


def feature_kv(features: DataFrame) -> DataFrame:
    """Sink shape of a feature record: (key, value JSON)."""
    return features.select(
        store_key().alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in FEATURE_COLUMNS])).alias("value"),
    )


def metric_kv(metrics: DataFrame) -> DataFrame:
    """Sink shape of a metric record: key = metric name."""
    return metrics.select(
        F.col("metric_name").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in METRIC_COLUMNS])).alias("value"),
    )


def valid_features(log: DataFrame) -> DataFrame:
    """Records the store accepts: non-empty entity id and feature name."""
    return log.filter(
        F.col("entity_id").isNotNull() & (F.col("entity_id") != "")
        & F.col("feature_name").isNotNull() & (F.col("feature_name") != "")
    )


def latest_features(log: DataFrame) -> DataFrame:
    """Latest record per (entity_id, feature_name) = last written."""
    order = F.struct("seq", "received_at", "computed_at")
    payload = F.struct("feature_value", "computed_at", "received_at", "seq")
    return (
        valid_features(log)
        .groupBy("entity_id", "feature_name")
        .agg(F.max_by(payload, order).alias("v"))
        .select("entity_id", "feature_name", "v.feature_value", "v.computed_at", "v.received_at", "v.seq")
    )


def entity_documents(latest: DataFrame) -> DataFrame:
    """entity -> JSON ``{feature_name: {value, computed_at, received_at}}``,
    ``received_at`` in whole epoch milliseconds.

    Built per entity from its latest rows only: one row per feature, that is
    three plus the number of categories, which bounds the list. Sorted by
    feature name so the text is deterministic."""
    entry = F.struct(
        F.col("feature_name").alias("key"),
        F.struct(F.col("feature_value").alias("value"), "computed_at",
                 (F.col("received_at") * F.lit(1000)).cast("bigint").alias("received_at")).alias("value"),
    )
    return latest.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("document"),
    )


def changelog_upserts(changes: DataFrame, kind: str = "kind") -> DataFrame:
    """Keep insert / update-after rows of an explicit changelog frame (row
    kinds ``+I``, ``-U``, ``+U``, ``-D``); retractions are dropped."""
    return changes.filter(F.col(kind).isin("+I", "+U")).drop(kind)


def write_latest(log: DataFrame, path: str) -> None:
    """The latest records of a log as a table sorted by entity, so that a lookup's filter
    skips the files and row groups that cannot hold it."""
    (latest_features(log).repartitionByRange("entity_id").sortWithinPartitions("entity_id", "feature_name")
     .write.mode("overwrite").parquet(path))
