"""Column expressions built from ``pyspark.sql.functions`` only (JVM-side)."""

from eventide.functions.display import age_text, fixed4, lag_text, watermark_clock_text
from eventide.functions.events import engaged, is_type, safe_rate
from eventide.functions.timefmt import (
    epoch_millis_of_iso,
    iso_micros,
    iso_seconds,
    parse_event_time,
    to_utc_timestamp_col,
)

__all__ = [
    "age_text", "fixed4", "lag_text", "watermark_clock_text",
    "engaged", "is_type", "safe_rate",
    "epoch_millis_of_iso", "iso_micros", "iso_seconds", "parse_event_time",
    "to_utc_timestamp_col",
]
