"""Windowed features: per-user hourly tumbling and per-content sliding windows.

Each accumulator of the reference is a set of algebraic aggregates
(``count``, ``count_if``, ``sum``), so Spark runs them as map-side partial
aggregation + one hash exchange on (key, window) + final merge. A hot key
sends one partial row per map task, never its raw events, to one reducer.
The functions work unchanged on batch and on streaming (watermarked) frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.config import (
    AVG_DWELL_TIME,
    CLICK_RATE,
    CONTENT_SLIDE,
    CONTENT_WINDOW,
    ENGAGEMENT_RATE,
    EVENT_CLICK,
    EVENT_LIKE,
    EVENT_SHARE,
    EVENT_VIEW,
    ISO_SECONDS,
    USER_WINDOW,
    WATERMARK_DELAY_SECONDS,
)
from eventide.functions.events import engaged, is_type, safe_rate
from eventide.functions.timefmt import iso_seconds
from eventide.schemas import FEATURE_COLUMNS


def user_window_aggregates(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """(user_id, window, n_events, n_clicks, dwell_sum) per 1 h tumbling window."""
    return (
        events.filter(F.col("user_id").isNotNull())
        .groupBy(F.col("user_id"), F.window(event_time, USER_WINDOW).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(is_type("event_type", EVENT_CLICK)).alias("n_clicks"),
            F.sum("dwell_time_ms").alias("dwell_sum"),
        )
    )


def _long_features(entity: Column, window_end: Column, pairs: list[tuple[str, Column]]) -> list[Column]:
    """One row per (name, value): an ``inline`` over a literal-size array."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("feature_name"), value.cast("double").alias("feature_value"))
        for name, value in pairs
    ])
    return [entity.alias("entity_id"), F.inline(rows), iso_seconds(window_end).alias("computed_at")]


def user_features_from_aggregates(agg: DataFrame) -> DataFrame:
    """One window group -> two feature rows: click_rate and avg_dwell_time.

    avg_dwell_time divides by all events of the window (likes and shares
    included), as the reference does.
    """
    n = F.col("n_events")
    cols = _long_features(
        F.col("user_id"), F.col("window.end"),
        [(CLICK_RATE, F.col("n_clicks") / n), (AVG_DWELL_TIME, F.col("dwell_sum") / n)],
    )
    return agg.select(*cols).select(*FEATURE_COLUMNS)


def user_features(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    return user_features_from_aggregates(user_window_aggregates(events, event_time))


def content_window_aggregates(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """(content_id, window, n_views, n_engaged) per 15 min window sliding by 5 min."""
    return (
        events.filter(F.col("content_id").isNotNull())
        .groupBy(F.col("content_id"), F.window(event_time, CONTENT_WINDOW, CONTENT_SLIDE).alias("window"))
        .agg(
            F.count_if(is_type("event_type", EVENT_VIEW)).alias("n_views"),
            F.count_if(engaged("event_type")).alias("n_engaged"),
        )
    )


def content_features_from_aggregates(agg: DataFrame) -> DataFrame:
    """engagement_rate = (likes + shares) / views; 0.0 without views."""
    return agg.select(
        F.col("content_id").alias("entity_id"),
        F.lit(ENGAGEMENT_RATE).alias("feature_name"),
        safe_rate(F.col("n_engaged"), F.col("n_views")).alias("feature_value"),
        iso_seconds(F.col("window.end")).alias("computed_at"),
    )


def content_features(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    return content_features_from_aggregates(content_window_aggregates(events, event_time))


def content_pane_aggregates(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """Pane form of the sliding window: aggregate once per 5-minute pane, then
    spread each pane to the three windows that contain it and add up.

    Equal to :func:`content_window_aggregates` because the accumulators merge
    by addition. The event-level pass does no 3x expansion; only the
    (far smaller) pane table is expanded.
    """
    panes = (
        events.filter(F.col("content_id").isNotNull())
        .groupBy(F.col("content_id"), F.window(event_time, CONTENT_SLIDE).start.alias("pane"))
        .agg(
            F.count_if(is_type("event_type", EVENT_VIEW)).alias("n_views"),
            F.count_if(engaged("event_type")).alias("n_engaged"),
        )
    )
    return (
        panes.groupBy(F.col("content_id"), F.window("pane", CONTENT_WINDOW, CONTENT_SLIDE).alias("window"))
        .agg(F.sum("n_views").alias("n_views"), F.sum("n_engaged").alias("n_engaged"))
    )


def content_features_panes(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    return content_features_from_aggregates(content_pane_aggregates(events, event_time))


def window_features(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """User and content window features in one long frame."""
    return user_features(events, event_time).unionByName(content_features(events, event_time))


USER_SQL = """
SELECT user_id AS entity_id, inline(array(
         struct('{click_rate}' AS feature_name, n_clicks / n_events AS feature_value),
         struct('{avg_dwell}' AS feature_name, dwell_sum / n_events AS feature_value))),
       date_format(window.end, "{stamp}") AS computed_at
FROM (SELECT user_id, window({event_time}, '{user_window}') AS window, count(*) AS n_events,
             count_if(lower(event_type) = '{click}') AS n_clicks, sum(dwell_time_ms) AS dwell_sum
      FROM {events} WHERE user_id IS NOT NULL GROUP BY user_id, window({event_time}, '{user_window}'))
"""
CONTENT_SQL = """
SELECT content_id AS entity_id, '{engagement}' AS feature_name,
       CASE WHEN n_views > 0 THEN n_engaged / n_views ELSE 0.0D END AS feature_value,
       date_format(window.end, "{stamp}") AS computed_at
FROM (SELECT content_id, window({event_time}, '{content_window}', '{content_slide}') AS window,
             count_if(lower(event_type) = '{view}') AS n_views,
             count_if(lower(event_type) IN ('{like}', '{share}')) AS n_engaged
      FROM {events} WHERE content_id IS NOT NULL
      GROUP BY content_id, window({event_time}, '{content_window}', '{content_slide}'))
"""


def window_features_sql(events: DataFrame, event_time: str = "event_time", view_suffix: str = "") -> DataFrame:
    """:func:`window_features` through Spark SQL over a temporary view of a batch or streaming frame."""
    view = f"user_events_view{view_suffix}"
    events.createOrReplaceTempView(view)
    names = dict(events=view, event_time=event_time, stamp=ISO_SECONDS, click_rate=CLICK_RATE, avg_dwell=AVG_DWELL_TIME,
                 engagement=ENGAGEMENT_RATE, user_window=USER_WINDOW, content_window=CONTENT_WINDOW, content_slide=CONTENT_SLIDE,
                 click=EVENT_CLICK, view=EVENT_VIEW, like=EVENT_LIKE, share=EVENT_SHARE)
    spark = events.sparkSession
    return spark.sql(USER_SQL.format(**names)).unionByName(spark.sql(CONTENT_SQL.format(**names)))


def closed_only(features: DataFrame, events: DataFrame, event_time: str = "event_time",
                computed_at: str = "computed_at") -> DataFrame:
    """Batch analogue of firing on the watermark: keep windows whose end is at
    or before max(event time) - 30 s (the final watermark). The maximum is a
    scalar subquery: one partial-aggregate pass, no join."""
    watermark = events.select(
        (F.max(F.col(event_time)) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(WATERMARK_DELAY_SECONDS)))
    ).scalar()
    return features.filter(F.to_timestamp(F.col(computed_at), "yyyy-MM-dd'T'HH:mm:ss'Z'") <= watermark)


def window_features_one_pass(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """Batch form of :func:`window_features` with one scan and one shuffle.

    Each event becomes one row for its user hour and three rows for its
    content windows (tagged by family); a single partial/final aggregation on
    (family, key, window end) computes both accumulators, and a final
    projection emits two user features or one content feature per group.
    Equal to the union form; streaming keeps the union form because Spark's
    watermark eviction needs ``window()`` grouping.
    """
    from eventide.config import CONTENT_SLIDE_SECONDS, CONTENT_WINDOW_SECONDS, USER_WINDOW_SECONDS
    from eventide.operators.late import floor_div

    us = F.unix_micros(F.col(event_time))
    hour = USER_WINDOW_SECONDS * 1_000_000
    slide = CONTENT_SLIDE_SECONDS * 1_000_000
    click = is_type("event_type", EVENT_CLICK)
    view = is_type("event_type", EVENT_VIEW)
    eng = engaged("event_type")

    def row(family: str, key: Column, end_us: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), key.alias("key"), end_us.alias("end_us"))

    per_event = [row("u", F.col("user_id"), (floor_div(us, hour) + 1) * F.lit(hour))]
    per_event += [row("c", F.col("content_id"), (floor_div(us, slide) + F.lit(o)) * F.lit(slide))
                  for o in range(1, CONTENT_WINDOW_SECONDS // CONTENT_SLIDE_SECONDS + 1)]
    grouped = (
        events.filter(F.col(event_time).isNotNull())
        .select(F.inline(F.array(*per_event)), click.alias("_click"), view.alias("_view"), eng.alias("_eng"),
                F.col("dwell_time_ms"))
        .filter(F.col("key").isNotNull())
        .groupBy("family", "key", "end_us")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("_click").alias("n_clicks"),
            F.sum("dwell_time_ms").alias("dwell_sum"),
            F.count_if("_view").alias("n_views"),
            F.count_if("_eng").alias("n_engaged"),
        )
    )
    n = F.col("n")
    user_rows = F.array(
        F.struct(F.lit(CLICK_RATE).alias("feature_name"), (F.col("n_clicks") / n).alias("feature_value")),
        F.struct(F.lit(AVG_DWELL_TIME).alias("feature_name"), (F.col("dwell_sum") / n).alias("feature_value")),
    )
    content_rows = F.array(
        F.struct(F.lit(ENGAGEMENT_RATE).alias("feature_name"),
                 safe_rate(F.col("n_engaged"), F.col("n_views")).alias("feature_value")),
    )
    return grouped.select(
        F.col("key").alias("entity_id"),
        F.inline(F.when(F.col("family") == "u", user_rows).otherwise(content_rows)),
        iso_seconds(F.timestamp_micros(F.col("end_us"))).alias("computed_at"),
    ).select(*FEATURE_COLUMNS)
