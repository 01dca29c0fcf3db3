"""Serving-side display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed4(value: Column) -> Column:
    """Number with four decimals; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string("%.4f", value))


def age_text(received_at: Column, now_seconds: Column) -> Column:
    """``--`` when absent/zero, ``Just now`` under one second, else ``Ns ago``."""
    elapsed = F.floor(now_seconds - received_at)
    return (
        F.when(received_at.isNull() | (received_at == 0), F.lit("--"))
        .when(elapsed < 1, F.lit("Just now"))
        .otherwise(F.concat(elapsed.cast("string"), F.lit("s ago")))
    )


def lag_text(last_sim_ms: Column, watermark_ms: Column) -> Column:
    """(last feature time - watermark) in seconds with one decimal, else ``--``.

    Rounded half away from zero on the exact millisecond count (integer
    arithmetic), so the text does not depend on binary floating point."""
    ok = (watermark_ms > 0) & (last_sim_ms > 0)
    lag = (last_sim_ms - watermark_ms).cast("bigint")
    tenths = F.floor((F.abs(lag) + F.lit(50)) / F.lit(100)).cast("bigint")
    text = F.concat(
        F.when(lag < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(tenths / F.lit(10)).cast("bigint").cast("string"), F.lit("."),
        (tenths % F.lit(10)).cast("string"), F.lit("s"),
    )
    return F.when(ok, text).otherwise(F.lit("--"))


def watermark_clock_text(watermark_ms: Column) -> Column:
    """Watermark as ``HH:mm:ssZ`` or NULL when no watermark was seen."""
    return F.when(
        watermark_ms > 0,
        F.date_format(F.timestamp_millis(watermark_ms.cast("bigint")), "HH:mm:ss'Z'"),
    )
