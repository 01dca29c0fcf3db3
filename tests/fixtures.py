"""Literal micro-fixtures (times on 2026-01-01, UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

DAY = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
EVENT_SCHEMA = "user_id string, content_id string, event_type string, dwell_time_ms bigint, event_time timestamp"


def at(hhmm: str, ss: int = 0) -> dt.datetime:
    h, m = map(int, hhmm.split(":"))
    return DAY.replace(hour=h, minute=m, second=ss)


def events(spark, rows):
    """rows of (user, content, type, dwell, time)."""
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def arrival_events(spark, rows):
    """rows of (event_id, user, content, type, event_time, arrival_ts)."""
    df = spark.createDataFrame(
        rows, "event_id bigint, user_id string, content_id string, event_type string, "
              "event_time timestamp, arrival_ts timestamp")
    return df.withColumn("dwell_time_ms", F.lit(0).cast("bigint"))
