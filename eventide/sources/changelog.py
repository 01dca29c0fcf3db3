"""Keyed upsert changelog -> latest snapshot (log-compaction semantics).

A changelog row is (key columns..., value columns..., seq, deleted). The
latest row per key by ``seq`` wins; a latest row that is a tombstone removes
the key. ``max_by`` is a declarative aggregate, so the work is a map-side
partial aggregation followed by one shuffle on the key: a hot key costs one
row per map task, not one task holding all its versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA_JSON = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("creator_id", T.StringType()),
    T.StructField("publish_timestamp", T.StringType()),
])


def latest_per_key(changelog: DataFrame, keys: list[str], order: str = "seq",
                   deleted: str | None = "deleted") -> DataFrame:
    values = [c for c in changelog.columns if c not in keys and c != order and c != deleted]
    payload = values + ([deleted] if deleted else [])
    latest = changelog.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]), F.col(order)).alias("_v"),
        F.max(order).alias(order),
    )
    if deleted:
        latest = latest.filter(~F.coalesce(F.col(f"_v.{deleted}"), F.lit(False)))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values], order)


def metadata_snapshot(changelog: DataFrame) -> DataFrame:
    """content metadata changelog -> (content_id, category, creator_id,
    publish_timestamp, seq); rows with a NULL key are skipped."""
    return latest_per_key(changelog.filter(F.col("content_id").isNotNull()), ["content_id"])


def parse_metadata_messages(raw: DataFrame, key_col: str = "key", value_col: str = "value",
                            seq_col: str = "offset") -> DataFrame:
    """Upsert messages (raw key, JSON value) -> changelog rows.

    Malformed JSON and missing fields are tolerated (NULLs); a NULL value is
    a delete; the key comes from the message key, as a raw-format key.
    """
    v = F.from_json(F.col(value_col), METADATA_JSON, {"mode": "PERMISSIVE"})
    return raw.select(
        F.coalesce(F.col(key_col).cast("string"), v["content_id"]).alias("content_id"),
        v["category"].alias("category"),
        v["creator_id"].alias("creator_id"),
        v["publish_timestamp"].alias("publish_timestamp"),
        F.col(seq_col).cast("bigint").alias("seq"),
        F.col(value_col).isNull().alias("deleted"),
        *[F.col(c) for c in ("partition",) if c in raw.columns],
    )


def metadata_to_messages(changelog: DataFrame) -> DataFrame:
    """Changelog rows -> upsert messages: key = content_id, value = JSON
    (NULL value for a delete), offset = seq."""
    value = F.to_json(F.struct("content_id", "category", "creator_id", "publish_timestamp"))
    return changelog.select(
        F.col("content_id").alias("key"),
        F.when(~F.coalesce(F.col("deleted"), F.lit(False)), value).alias("value"),
        F.col("seq").alias("offset"),
    )
