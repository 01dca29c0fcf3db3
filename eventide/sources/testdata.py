"""Reference-shaped inputs derived from the driver's parquet tables.

``events`` becomes the user-event stream and ``part`` becomes the
content-metadata upsert changelog (several versions per key; the greatest
offset wins). Every derived column is a built-in expression, so scans keep
column pruning and the derivations fuse into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.config import AVG_DWELL_TIME, CLICK_RATE
from eventide.functions.timefmt import to_utc_timestamp_col
from eventide.operators.store import store_key
from eventide.session import prepare

# Fixed values of the test-data mapping (FIXTURES.md §2-3).
CONTENT_KEYS = 100            # metadata key = p_partkey mod 100, events key = props.k (0-99)
LATE_EVERY = 20               # every 20th event arrives late ...
LATE_MIN_MINUTES = 35         # ... by 35 to 90 minutes
LATE_SPAN_MINUTES = 56
LATE_STEP = 7


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shape_events(events: DataFrame) -> DataFrame:
    """driver ``events`` -> (event_id, user_id, content_id, event_type,
    dwell_time_ms, event_time, arrival_ts)."""
    et = F.col("event_type")
    event_time = to_utc_timestamp_col("ts")
    delay = F.when(
        F.col("event_id") % LATE_EVERY == 0,
        (F.lit(LATE_MIN_MINUTES) + (F.col("event_id") * LATE_STEP) % LATE_SPAN_MINUTES).cast("int"),
    ).otherwise(F.lit(0))
    return events.select(
        F.col("event_id"),
        F.concat(F.lit("usr_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("cnt_"), F.get_json_object("props", "$.k")).alias("content_id"),
        F.when(et == "purchase", F.lit("like"))
        .when(et == "signup", F.lit("share"))
        .otherwise(et)
        .alias("event_type"),
        F.when(et.isin("view", "click"), F.round(F.col("value") * 1000).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("dwell_time_ms"),
        event_time.alias("event_time"),
        (event_time + F.make_dt_interval(F.lit(0), F.lit(0), delay, F.lit(0))).alias("arrival_ts"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(read_table(spark, sf_dir, "events"))


def shape_metadata_changelog(part: DataFrame) -> DataFrame:
    """driver ``part`` -> upsert changelog (content_id, category, creator_id,
    publish_timestamp, seq, deleted)."""
    return part.select(
        F.concat(F.lit("cnt_"), (F.col("p_partkey") % CONTENT_KEYS).cast("string")).alias("content_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("creator_id"),
        F.lit(None).cast("string").alias("publish_timestamp"),
        F.col("p_partkey").alias("seq"),
        F.lit(False).alias("deleted"),
    )


def metadata_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_metadata_changelog(read_table(spark, sf_dir, "part"))


# ---------------------------------------------------------------------------
# wire shapes: what readers and parsers are given
# ---------------------------------------------------------------------------
PARSE_VARIANTS = 7


def events_json(ev: DataFrame) -> DataFrame:
    """Shaped events published as JSON, each row in one of seven wire shapes:
    0 timestamp without zone, 1 timestamp with +00:00 offset, 2 dwell as a
    JSON string, 3 dwell with a fraction, 4 dwell missing, 5 upper-case type
    plus an unknown field, 6 plain. One ``to_json`` per row; the dwell field
    is spliced in as text so the expression stays small enough for codegen."""
    v = F.col("event_id") % PARSE_VARIANTS
    micros = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = (F.when(v == 0, micros)
             .when(v == 1, F.concat(micros, F.lit("+00:00")))
             .otherwise(F.concat(micros, F.lit("Z"))))
    etype = F.when(v == 5, F.upper("event_type")).otherwise(F.col("event_type"))
    head = F.to_json(F.struct("user_id", "content_id", etype.alias("event_type"), stamp.alias("timestamp")))
    dwell = F.col("dwell_time_ms").cast("string")
    tail = (F.when(v == 2, F.concat(F.lit(',"dwell_time_ms":"'), dwell, F.lit('"}')))
            .when(v == 3, F.concat(F.lit(',"dwell_time_ms":'), dwell, F.lit('.7}')))
            .when(v == 4, F.lit("}"))
            .when(v == 5, F.concat(F.lit(',"dwell_time_ms":'), dwell, F.lit(',"client":"web"}')))
            .otherwise(F.concat(F.lit(',"dwell_time_ms":'), dwell, F.lit("}"))))
    return ev.select("event_id", head.alias("head_json"), tail.alias("tail")).select(
        "event_id", F.concat(F.expr("substring(head_json, 1, length(head_json) - 1)"), F.col("tail")).alias("value"))


def serving_messages(log: DataFrame, metrics: DataFrame) -> DataFrame:
    """Both topics as the serving reader gets them, with messages it must skip:
    an empty one beside each click rate, one without an entity beside each average."""
    def topic(name: str, rows: DataFrame, value: Column, offset: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("topic"), "key", value.alias("value"), offset.alias("offset"),
                           F.timestamp_micros(offset).alias("arrival_ts"))

    offset = (F.col("received_at") * F.lit(1_000_000)).cast("bigint")
    features = log.withColumn("key", store_key())
    text = F.to_json(F.struct("entity_id", "feature_name", "feature_value", "computed_at"))
    nameless = F.to_json(F.struct(F.lit("").alias("entity_id"), "feature_name", "feature_value", "computed_at"))
    m = metrics.withColumn("key", F.col("metric_name"))
    return (topic("feature-store", features, text, offset)
            .unionByName(topic("feature-store", features.filter(F.col("feature_name") == CLICK_RATE), F.lit(""), offset))
            .unionByName(topic("feature-store", features.filter(F.col("feature_name") == AVG_DWELL_TIME), nameless, offset))
            .unionByName(topic("flink-metrics", m, F.to_json(F.struct("metric_name", "metric_value", "computed_at")), F.col("seq"))))
