"""User-event JSON -> typed event rows.

Rules kept from the reference:
* unknown JSON fields are ignored;
* a timestamp that is not an ISO instant with ``Z`` (or is missing) takes the
  processing time instead of being rejected; accepted times are truncated
  to milliseconds;
* a missing or null ``dwell_time_ms`` is 0; ``"12"`` and ``12.7`` both coerce to 12; what is
  present but no number, or out of range, is malformed;
* malformed JSON fails the query (``FAILFAST``); ``PERMISSIVE`` is offered and
  malformed rows can be split off with :func:`split_malformed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.timefmt import iso_micros, parse_event_time
from eventide.schemas import USER_EVENT_JSON

CORRUPT_COLUMN = "_corrupt_record"


def events_to_json(events: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Typed events -> (key, value) the way the producer publishes them:
    key = user_id, value = JSON text."""
    ts = timestamp if timestamp is not None else iso_micros("event_time")
    body = F.to_json(F.struct(
        F.col("user_id"), F.col("content_id"), F.col("event_type"),
        F.col("dwell_time_ms"), ts.alias("timestamp"),
    ))
    return events.select(F.col("user_id").alias("key"), body.alias("value"))


def _dwell(text: Column, fail: bool) -> Column:
    as_int = text.try_cast(T.DoubleType()).try_cast(T.LongType())
    if fail:
        error = F.raise_error(F.concat(F.lit("dwell_time_ms is no number in range: "), text)).cast("bigint")
        as_int = F.when(text.isNotNull() & as_int.isNull(), error).otherwise(as_int)
    return F.coalesce(as_int, F.lit(0).cast("bigint"))


def _bad_dwell(text: Column) -> Column:
    return text.isNotNull() & text.try_cast(T.DoubleType()).try_cast(T.LongType()).isNull()


def drop_empty(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Skip NULL / empty messages. Apply it where ``value`` is a source column:
    a filter over a computed value would be pushed down and evaluated twice."""
    value = F.col(value_col)
    return raw.filter(value.isNotNull() & (F.length(value) > 0))


def parse_events(raw: DataFrame, value_col: str = "value", mode: str = "FAILFAST",
                 fallback_time: Column | None = None, keep: list[str] | None = None,
                 skip_empty: bool = False) -> DataFrame:
    """JSON text column -> (user_id, content_id, event_type, dwell_time_ms,
    event_time [, kept columns]). ``skip_empty`` drops empty messages first
    (the stream readers do that on the raw column already)."""
    keep = keep or []
    schema = USER_EVENT_JSON
    options = {"mode": mode}
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType(USER_EVENT_JSON.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
    value = F.col(value_col)
    e = F.from_json(value, schema, options).alias("e")
    permissive = mode.upper() == "PERMISSIVE"
    rows = (drop_empty(raw, value_col) if skip_empty else raw).select(e, *([value.alias("_raw")] if permissive else []), *keep)
    out = [
        F.col("e.user_id").alias("user_id"),
        F.col("e.content_id").alias("content_id"),
        F.col("e.event_type").alias("event_type"),
        _dwell(F.col("e.dwell_time_ms"), fail=not permissive).alias("dwell_time_ms"),
        parse_event_time(F.col("e.timestamp"), fallback_time).alias("event_time"),
    ]
    if mode.upper() == "PERMISSIVE":
        out.append(F.coalesce(F.col(f"e.{CORRUPT_COLUMN}"), F.when(_bad_dwell(F.col("e.dwell_time_ms")), F.col("_raw")))
                   .alias(CORRUPT_COLUMN))
    return rows.select(*out, *keep)


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a PERMISSIVE parse."""
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT_COLUMN), parsed.filter(bad)


def publish_files(messages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write (key, value) messages as JSON-lines text, hash-partitioned by key
    so one key's messages stay in one file per write, like a keyed topic."""
    n = partitions or messages.sparkSession.sparkContext.defaultParallelism
    messages.repartition(n, "key").select("value").write.mode("append").text(path)
