"""Event predicates and zero-safe rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.config import EVENT_LIKE, EVENT_SHARE


def is_type(event_type: Column | str, name: str) -> Column:
    """Case-insensitive, null-safe event-type test (NULL -> not counted)."""
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.lower(c) == F.lit(name)


def engaged(event_type: Column | str) -> Column:
    """like or share, case-insensitive."""
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.lower(c).isin(EVENT_LIKE, EVENT_SHARE)


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0.0 when the denominator is 0."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), F.nullif(denominator, F.lit(0)).cast("double")),
        F.lit(0.0),
    )
