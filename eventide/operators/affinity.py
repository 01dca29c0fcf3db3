"""Category affinity: running count of events per (user, category).

The reference joins every event to the metadata table and then counts. Here
the events are first reduced to (user, content) pair counts (map-side
partial aggregation), and only the pairs are joined to the latest metadata
snapshot. Since content_id is unique in the snapshot, summing pair counts per
(user, category) gives the same numbers. A metadata change re-attributes the
past events of that content, as the reference's retracting join does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.config import AFFINITY_PREFIX
from eventide.schemas import FEATURE_COLUMNS


def pair_counts(events: DataFrame) -> DataFrame:
    """(user_id, content_id, n). No watermark and no window: lifetime counts."""
    return (
        events.filter(F.col("user_id").isNotNull() & F.col("content_id").isNotNull())
        .groupBy("user_id", "content_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def affinity_counts(pairs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """pairs ⋈ snapshot -> (user_id, category, n). NULL categories produce no
    feature (their feature name would be NULL).

    The pairs come from a shuffle anyway, so the join is left to AQE: it
    broadcasts the snapshot when its measured size allows
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``) and splits hot
    contents otherwise."""
    meta = snapshot.filter(F.col("category").isNotNull()).select("content_id", "category")
    return (
        pairs.join(meta, "content_id", "inner")
        .groupBy("user_id", "category")
        .agg(F.sum("n").alias("n"))
    )


def affinity_features_from_counts(counts: DataFrame, computed_at: Column) -> DataFrame:
    return counts.select(
        F.col("user_id").alias("entity_id"),
        F.concat(F.lit(AFFINITY_PREFIX), F.col("category")).alias("feature_name"),
        F.col("n").cast("double").alias("feature_value"),
        computed_at.alias("computed_at"),
    ).select(*FEATURE_COLUMNS)


def affinity_features(events: DataFrame, snapshot: DataFrame, computed_at: Column) -> DataFrame:
    return affinity_features_from_counts(affinity_counts(pair_counts(events), snapshot), computed_at)


AFFINITY_SQL = """
SELECT p.user_id AS entity_id,
       concat('{prefix}', c.category) AS feature_name,
       CAST(sum(p.n) AS DOUBLE) AS feature_value,
       {computed_at} AS computed_at
FROM (SELECT user_id, content_id, count(*) AS n
      FROM {events}
      WHERE user_id IS NOT NULL AND content_id IS NOT NULL
      GROUP BY user_id, content_id) p
JOIN {metadata} c ON p.content_id = c.content_id
WHERE c.category IS NOT NULL
GROUP BY p.user_id, c.category
"""


def affinity_features_sql(events: DataFrame, snapshot: DataFrame, computed_at_sql: str,
                          view_suffix: str = "") -> DataFrame:
    """The same affinity through Spark SQL over temporary views (stream or
    batch frame -> view -> query). Pair counts are aggregated in a subquery
    before the join, as in the DataFrame form. Each caller that may run beside
    another passes its own ``view_suffix``: view names are the session's."""
    spark = events.sparkSession
    ev_view, meta_view = f"user_events_view{view_suffix}", f"content_metadata_table{view_suffix}"
    events.createOrReplaceTempView(ev_view)
    snapshot.filter(F.col("category").isNotNull()).select("content_id", "category").createOrReplaceTempView(meta_view)
    return spark.sql(AFFINITY_SQL.format(prefix=AFFINITY_PREFIX, computed_at=computed_at_sql,
                                         events=ev_view, metadata=meta_view))
