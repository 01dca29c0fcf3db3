"""Record schemas (fixed; no inference)."""

from pyspark.sql import types as T

# Raw user event as published (JSON text on the wire). dwell_time_ms and
# timestamp are read as strings so that lenient coercion rules can be applied.
USER_EVENT_JSON = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("dwell_time_ms", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Parsed, typed event used by every operator.
USER_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("dwell_time_ms", T.LongType(), False),
    T.StructField("event_time", T.TimestampType()),
])

CONTENT_METADATA = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("creator_id", T.StringType()),
    T.StructField("publish_timestamp", T.StringType()),
])

FEATURE_RECORD = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("feature_name", T.StringType()),
    T.StructField("feature_value", T.DoubleType()),
    T.StructField("computed_at", T.StringType()),
])

# Feature log row = record + write order (seq) + arrival time at the store.
FEATURE_LOG = T.StructType(FEATURE_RECORD.fields + [
    T.StructField("received_at", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])

METRIC_RECORD = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("computed_at", T.StringType()),
])

METRIC_LOG = T.StructType(METRIC_RECORD.fields + [
    T.StructField("seq", T.LongType()),
])

FEATURE_COLUMNS = [f.name for f in FEATURE_RECORD.fields]
FEATURE_LOG_COLUMNS = [f.name for f in FEATURE_LOG.fields]
METRIC_COLUMNS = [f.name for f in METRIC_RECORD.fields]
