"""Serving queries over the feature log / store and the metric log.

``now`` is always a parameter (epoch seconds column), never the wall clock
inside a query, so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.config import (
    AFFINITY_PREFIX,
    CLICK_RATE,
    ENGAGEMENT_RATE,
    FEED_FEATURE_UPDATE,
    FEED_METRICS_UPDATE,
    FEED_STATE_DUMP,
    METRIC_CURRENT_WATERMARK,
    METRIC_LATE_EVENTS_DROPPED,
    RECENT_UPDATES_CAP,
)
from eventide.functions.display import age_text, fixed4, lag_text, watermark_clock_text
from eventide.functions.timefmt import epoch_millis_of_iso


def entity_lookup(latest: DataFrame, entity_id: str | Column) -> DataFrame:
    """All latest features of one entity (the argument is trimmed)."""
    key = F.trim(F.lit(entity_id) if isinstance(entity_id, str) else entity_id)
    return latest.filter(F.col("entity_id") == key).select(
        "entity_id", "feature_name", "feature_value", "computed_at", "received_at")


def entity_report(lookup: DataFrame, now_seconds: Column) -> DataFrame:
    """Rows of the entity table: name, value (4 decimals), computed_at, age."""
    return lookup.select(
        "entity_id", "feature_name",
        fixed4(F.col("feature_value")).alias("value_text"),
        "computed_at",
        age_text(F.col("received_at"), now_seconds).alias("age"),
    )


def last_window_time(log: DataFrame) -> Column:
    """computed_at (epoch ms) of the last written window feature, as a scalar
    subquery; affinity records carry wall-clock times and are left out."""
    window_rows = log.filter(~F.col("feature_name").startswith(AFFINITY_PREFIX))
    ms = epoch_millis_of_iso(F.col("computed_at"))
    return window_rows.filter(ms.isNotNull()).select(
        F.max_by(ms, F.struct("seq", "received_at", "computed_at"))).scalar()


def metric_state(metrics: DataFrame, log: DataFrame | None = None, last_sim: Column | None = None) -> DataFrame:
    """One row: late_events_dropped (running total), current_watermark (last
    sample, epoch ms), last_sim_time (computed_at of the last written window
    feature, epoch ms). ``last_sim`` defaults to :func:`last_window_time` of
    ``log``; either way it is a scalar, not a join."""
    if last_sim is None:
        last_sim = last_window_time(log)
    is_late = F.col("metric_name") == METRIC_LATE_EVENTS_DROPPED
    is_wm = F.col("metric_name") == METRIC_CURRENT_WATERMARK
    return metrics.agg(
        F.coalesce(F.sum(F.when(is_late, F.col("metric_value").cast("bigint"))), F.lit(0)).cast("bigint")
        .alias("late_events_dropped"),
        F.coalesce(F.max_by(F.when(is_wm, F.col("metric_value")), F.when(is_wm, F.col("seq"))).cast("bigint"),
                   F.lit(0).cast("bigint")).alias("current_watermark"),
    ).select("*", F.coalesce(last_sim, F.lit(0)).cast("bigint").alias("last_sim_time"))


def watermark_lag(state: DataFrame) -> DataFrame:
    wm, last = F.col("current_watermark"), F.col("last_sim_time")
    return state.select(
        "current_watermark", "last_sim_time",
        F.when((wm > 0) & (last > 0), last - wm).alias("lag_ms"),
        lag_text(last, wm).alias("lag_text"),
        watermark_clock_text(wm).alias("watermark_clock"),
    )


def freshness(log: DataFrame, now_seconds: Column,
              names: tuple[str, ...] = (CLICK_RATE, ENGAGEMENT_RATE)) -> DataFrame:
    """Age of the newest arrival per feature name; ``--`` when none. A record's
    newest arrival is its key's latest one, so the log needs no grouping by key:
    one global partial aggregation, then one row per name."""
    newest = [F.max(F.when(F.col("feature_name") == n, F.col("received_at"))).alias(n) for n in names]
    return freshness_of(log.filter(F.col("feature_name").isin(*names)).agg(*newest), now_seconds, names)


def freshness_of(newest: DataFrame, now_seconds: Column,
                 names: tuple[str, ...] = (CLICK_RATE, ENGAGEMENT_RATE)) -> DataFrame:
    """:func:`freshness` of one row that has the newest arrival of each name in a column of that name."""
    rows = F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(n).alias("last_received_at")) for n in names])
    return newest.select(now_seconds.alias("_now"), F.inline(rows)).select(
        "feature_name", "last_received_at", age_text(F.col("last_received_at"), F.col("_now")).alias("age"))


def recent_updates(log: DataFrame, n: int = RECENT_UPDATES_CAP) -> DataFrame:
    """Newest ``n`` feature arrivals (top-k; the cap is the feature)."""
    msg = F.concat(F.lit("Received feature: "), F.col("entity_id"), F.lit(" | "), F.col("feature_name"),
                   F.lit(" = "), F.coalesce(fixed4(F.col("feature_value")), F.lit("null")))
    return (
        log.orderBy(F.col("received_at").desc(), F.col("seq").desc(), F.col("computed_at").desc(),
                    F.col("entity_id").asc(), F.col("feature_name").asc())
        .limit(n)
        .select("received_at", "entity_id", "feature_name", "feature_value", "computed_at", msg.alias("message"))
    )


STATE_BLOCK = 3_600_000_000    # micros of message time that one task puts in order


def running_state(metrics: DataFrame, log: DataFrame) -> DataFrame:
    """(seq, late_events_dropped, current_watermark, last_sim_time): the serving
    state once every message up to ``seq`` (micros) has been read.

    Changes are summed per ``seq`` first, put in order per block of message
    time, and completed by a carry over the blocks before it; only the block
    table (one row per hour with messages) is ordered as one sequence."""
    is_late = F.col("metric_name") == METRIC_LATE_EVENTS_DROPPED
    is_wm = F.col("metric_name") == METRIC_CURRENT_WATERMARK
    number = F.col("metric_value").cast("bigint")
    none = F.lit(None).cast("bigint")
    changes = metrics.select("seq", F.when(is_late, number).alias("late"), F.when(is_wm, number).alias("wm"), none.alias("sim"))
    windows = log.filter(~F.col("feature_name").startswith(AFFINITY_PREFIX)).select(
        (F.col("received_at") * F.lit(1_000_000)).cast("bigint").alias("seq"), none.alias("late"), none.alias("wm"),
        epoch_millis_of_iso(F.col("computed_at")).alias("sim"))
    merged = [F.sum("late").alias("late"), F.max("wm").alias("wm"), F.max("sim").alias("sim")]
    per_seq = changes.unionByName(windows).groupBy("seq").agg(*merged).withColumn(
        "block", F.floor(F.col("seq") / F.lit(STATE_BLOCK)))
    inside = Window.partitionBy("block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_seq.groupBy("block").agg(*merged).select(
        "block", F.sum("late").over(before).alias("late0"), F.max("wm").over(before).alias("wm0"),
        F.max("sim").over(before).alias("sim0"))
    rows = per_seq.select("block", "seq", F.sum("late").over(inside).alias("late"), F.max("wm").over(inside).alias("wm"),
                          F.max("sim").over(inside).alias("sim")).join(carry, "block")
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "seq", (F.coalesce("late", zero) + F.coalesce("late0", zero)).alias("late_events_dropped"),
        F.coalesce(F.greatest("wm", "wm0"), zero).alias("current_watermark"),
        F.coalesce(F.greatest("sim", "sim0"), zero).alias("last_sim_time"))


def feature_update(log: DataFrame) -> Column:
    """JSON of a ``feature_update`` message; arrival as whole epoch milliseconds."""
    return F.to_json(F.struct(
        F.lit(FEED_FEATURE_UPDATE).alias("type"), "entity_id", "feature_name",
        F.struct(F.col("feature_value").alias("value"), "computed_at",
                 (F.col("received_at") * F.lit(1000)).cast("bigint").alias("received_at")).alias("data")))


def change_feed(log: DataFrame, metrics: DataFrame) -> DataFrame:
    """Message stream of the store: one ``feature_update`` per feature record,
    and one ``metrics_update`` per metric record with the state it leads to."""
    features = log.select(F.col("received_at").alias("at"), F.col("seq"), feature_update(log).alias("message"))
    metric = metrics.select("seq").join(running_state(metrics, log), "seq").select(
        (F.col("seq") / F.lit(1_000_000.0)).alias("at"), F.col("seq"),
        F.to_json(F.struct(F.lit(FEED_METRICS_UPDATE).alias("type"), "late_events_dropped", "current_watermark",
                           "last_sim_time")).alias("message"),
    )
    return features.unionByName(metric)


def state_snapshot(documents: DataFrame, state: DataFrame) -> DataFrame:
    """``state_dump``: a ``features`` row per entity document and one ``metrics``
    row (without an entity, so no entity id can collide with it)."""
    def part(name: str, entity: Column, document: Column) -> list[Column]:
        return [F.lit(FEED_STATE_DUMP).alias("type"), F.lit(name).alias("part"), entity.alias("entity_id"), document.alias("document")]

    metrics_doc = state.select(*part("metrics", F.lit(None).cast("string"), F.to_json(
        F.struct("late_events_dropped", "current_watermark", "last_sim_time"))))
    return documents.select(*part("features", F.col("entity_id"), F.col("document"))).unionByName(metrics_doc)
