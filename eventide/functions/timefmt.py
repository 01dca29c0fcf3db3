"""Time parsing and formatting (session time zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.config import ISO_INSTANT_PATTERN, ISO_MICROS, ISO_SECONDS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_seconds(ts: Column | str) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ssZ`` (window ends, computed_at)."""
    return F.date_format(_col(ts), ISO_SECONDS)


def iso_micros(ts: Column | str) -> Column:
    """Timestamp -> ISO instant with microseconds."""
    return F.date_format(_col(ts), ISO_MICROS)


def to_utc_timestamp_col(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ wall clock (read as UTC) -> TIMESTAMP instant.

    Watermarks need TIMESTAMP; the session zone is UTC so the cast keeps
    the wall-clock value.
    """
    return _col(ts).cast(T.TimestampType())


def parse_event_time(text: Column | str, fallback: Column | None = None) -> Column:
    """ISO instant text -> event time, truncated to milliseconds.

    Only instants with a ``Z`` suffix are accepted (no zone, offsets and junk
    are rejected); a rejected or missing value takes ``fallback``
    (processing time). The fallback is a parameter so batch runs stay
    deterministic; by default it is the query's current timestamp, which
    Spark evaluates once per query/micro-batch.
    """
    t = _col(text)
    accepted = F.when(t.rlike(ISO_INSTANT_PATTERN), F.upper(t).try_cast(T.TimestampType()))
    parsed = F.date_trunc("millisecond", accepted)
    if fallback is None:
        fallback = F.current_timestamp()
    return F.coalesce(parsed, fallback)


def epoch_millis_of_iso(text: Column | str) -> Column:
    """Tolerant ISO text -> epoch milliseconds; NULL when unparseable."""
    t = F.regexp_replace(_col(text), "[Zz]$", "")
    ts = F.coalesce(
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]")),
    )
    return F.unix_millis(ts)
