"""Late events as data: classification, metrics, share, divergence.

Definition (the per-row limit of the reference's rule): replayed in arrival
order, the watermark seen by an event is max(event time of strictly earlier
arrivals) - 30 s. An event is late for a window when the window end is at or
before that watermark. The hourly branch tests the event's hour; the sliding
branch reports an event only when its *last* window is closed (earlier closed
windows are skipped silently, which matters for :func:`divergence`).

Distributed form, no global ordering. ``end <= max(ts of earlier) - L`` holds
iff some earlier arrival has ``ts >= end + L``, i.e. iff
``earliest(end) < arrival(e)`` with ``earliest(T) = min{arrival(x) : ts(x) >= T}``.
Window ends lie on a grid (1 h, or 5 min for the sliding windows), so
``earliest`` is needed only at grid thresholds ``k*G + L``. Per slot
``floor((ts - L) / G)`` the minimum arrival is a partial aggregation; a
suffix minimum over slots (two levels: inside blocks of slots, then across
block minima) gives ``earliest`` for every threshold. That table grows with
the event-time span, not with the row count; each query writes it once as a
small table, counts it, and broadcasts it to a map-side join with the events.

Arrival keys (arrival time, id) are packed into one decimal, a fixed-width
aggregation buffer, so minima are hash aggregates. An event emits one row per
branch; the thresholds that its windows need follow from the slot table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.config import (
    AVG_DWELL_TIME,
    CLICK_RATE,
    CONTENT_SLIDE_SECONDS,
    CONTENT_WINDOW_SECONDS,
    ENGAGEMENT_RATE,
    EVENT_CLICK,
    EVENT_VIEW,
    ISO_SECONDS,
    MAX_BROADCAST_ROWS,
    METRIC_CURRENT_WATERMARK,
    METRIC_LATE_EVENTS_DROPPED,
    SLOT_BLOCK,
    USER_WINDOW_SECONDS,
    WATERMARK_DELAY_SECONDS,
)
from eventide.functions.events import engaged, is_type, safe_rate
from eventide.functions.timefmt import iso_micros, iso_seconds
from eventide.operators.feature_join import join_features
from eventide.session import materialise

MICROS = 1_000_000
USER_BRANCH = "user_window"
CONTENT_BRANCH = "content_window"
# branch -> (grid seconds, offsets k - floor(ts / grid) of the window ends needed)
BRANCHES = {
    USER_BRANCH: (USER_WINDOW_SECONDS, (1,)),
    CONTENT_BRANCH: (CONTENT_SLIDE_SECONDS, tuple(range(1, CONTENT_WINDOW_SECONDS // CONTENT_SLIDE_SECONDS + 1))),
}
CONTENT_LAST_OFFSET = CONTENT_WINDOW_SECONDS // CONTENT_SLIDE_SECONDS
# Watermark sampling period of the batch replay, in arrival time: 5 s of wall
# clock at the reference's 60x simulated clock.
WATERMARK_SAMPLE_SECONDS = 300


def floor_div(c: Column, n: int) -> Column:
    """Exact floor division of a bigint column by a positive constant."""
    return F.floor((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("bigint")


def running_extreme(table: DataFrame, part: list[str], key: str, value: str, out: str,
                    fn=F.min, descending: bool = True, block: int = SLOT_BLOCK) -> DataFrame:
    """Running ``fn`` of ``value`` ordered by ``key`` (suffix when descending),
    including the current row, per ``part``. Two levels: a window per block of
    ``block`` keys, plus a carry from the block extremes before it. Only the
    block table is ordered as one sequence in one task. It has one row per
    block that holds any key, at most (key range / block): about 256k rows for
    5-minute slots over the whole four-digit calendar."""
    order = F.col(key).desc() if descending else F.col(key).asc()
    t = table.withColumn("_blk", floor_div(F.col(key), block))
    w_in = Window.partitionBy(*part, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = t.withColumn("_in", fn(value).over(w_in))
    border = F.col("_blk").desc() if descending else F.col("_blk").asc()
    w_blk = Window.partitionBy(*part).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    carry = (t.groupBy(*part, "_blk").agg(fn(value).alias("_bx"))
             .select(*part, "_blk", fn("_bx").over(w_blk).alias("_carry")))
    pick = F.least if fn is F.min else F.greatest
    return (inner.join(carry, [*part, "_blk"])
            .select(*part, key, pick("_in", "_carry").alias(out)))


def _arrival(arrival: list[str]) -> Column:
    """(arrival time, non-negative id) as one decimal: 17 digits of micros, 19 of the id."""
    at, number = arrival
    return (F.unix_micros(F.col(at)).cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)")
            + F.col(number).cast("decimal(19,0)")).cast("decimal(38,0)")


def earliest_arrival_table(events: DataFrame, event_time: str = "event_time",
                           arrival: list[str] | None = None,
                           lateness_seconds: int = WATERMARK_DELAY_SECONDS) -> DataFrame:
    """(branch, k, earliest): min arrival key over events with
    ``ts >= k * grid + lateness``, for every k some event needs."""
    arrival = arrival or ["arrival_ts", "event_id"]
    us = F.unix_micros(F.col(event_time))
    late_us = lateness_seconds * MICROS
    entries = [F.struct(F.lit(branch).alias("branch"), floor_div(us - F.lit(late_us), grid * MICROS).alias("k"),
                        _arrival(arrival).alias("a")) for branch, (grid, _) in BRANCHES.items()]
    per_slot = (
        events.filter(F.col(event_time).isNotNull())
        .select(F.inline(F.array(*entries)))
        .groupBy("branch", "k").agg(F.min("a").alias("m"))
    )
    # an event of slot s lies in grid cell s .. s + ceil(lateness / grid), so its
    # windows end among the next few cells: empty entries for those, from slots only
    none = F.lit(None).cast("decimal(38,0)")
    needed = F.lit(None)
    for branch, (grid, offsets) in BRANCHES.items():
        last = -(-lateness_seconds // grid) + max(offsets)
        needed = F.when(F.col("branch") == branch, F.sequence(F.lit(0), F.lit(last))).otherwise(needed)
    spread = F.transform(needed, lambda o: F.struct((F.col("k") + o).alias("k"), F.when(o == 0, F.col("m")).otherwise(none).alias("m")))
    table = per_slot.select("branch", F.inline(spread)).groupBy("branch", "k").agg(F.min("m").alias("m"))
    return running_extreme(table, ["branch"], "k", "m", "earliest", F.min, descending=True)


def threshold_table(events: DataFrame, event_time: str = "event_time",
                    arrival: list[str] | None = None) -> DataFrame:
    """Earliest-arrival table, written once per query and counted.

    It has at most span / grid + a few rows per branch, of fixed width. The
    exact row count decides the broadcast; beyond the bound the join stays a
    shuffle join on k (AQE splits hot slots)."""
    table = materialise(earliest_arrival_table(events, event_time, arrival), "thresholds")
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def _end_index(event_time: str, branch: str, offset: int) -> Column:
    grid = BRANCHES[branch][0] * MICROS
    return floor_div(F.unix_micros(F.col(event_time)), grid) + F.lit(offset)


def _end_ts(event_time: str, branch: str, offset: int) -> Column:
    return F.timestamp_micros(_end_index(event_time, branch, offset) * F.lit(BRANCHES[branch][0] * MICROS))


def _lookup(events: DataFrame, table: DataFrame, branch: str, k: Column, out: str) -> DataFrame:
    t = table.filter(F.col("branch") == branch).select(F.col("k").alias(f"_k_{out}"), F.col("earliest").alias(out))
    return events.join(t, k == F.col(f"_k_{out}"), "left").drop(f"_k_{out}")


def classify(events: DataFrame, event_time: str = "event_time",
             arrival: list[str] | None = None, table: DataFrame | None = None,
             branches: tuple[str, ...] = (USER_BRANCH, CONTENT_BRANCH)) -> DataFrame:
    """events + late_user_window and user_window_end (the event's hour end),
    late_content_window and content_last_window_end (its last sliding window's
    end); only the columns, and joins, of the given ``branches``."""
    arrival = arrival or ["arrival_ts", "event_id"]
    table = table if table is not None else threshold_table(events, event_time, arrival)
    names = {USER_BRANCH: ("late_user_window", "user_window_end", 1),
             CONTENT_BRANCH: ("late_content_window", "content_last_window_end", CONTENT_LAST_OFFSET)}
    x, flags, ends = events, [], []
    for branch in branches:
        flag, end, offset = names[branch]
        x = _lookup(x, table, branch, _end_index(event_time, branch, offset), f"_{flag}")
        flags.append(F.coalesce(F.col(f"_{flag}") < _arrival(arrival), F.lit(False)).alias(flag))
        ends.append(_end_ts(event_time, branch, offset).alias(end))
    return x.select(*events.columns, *flags, *ends)


def _late_rows(classified: DataFrame, flag: str, end: str) -> DataFrame:
    return classified.filter(F.col(flag)).select(
        "event_id", "user_id", "content_id", "event_type",
        iso_micros("event_time").alias("event_time"),
        iso_micros("arrival_ts").alias("arrival_ts"),
        iso_seconds(end).alias("window_end"),
    )


def late_user_events(classified: DataFrame) -> DataFrame:
    return _late_rows(classified, "late_user_window", "user_window_end")


def late_content_events(classified: DataFrame) -> DataFrame:
    return _late_rows(classified, "late_content_window", "content_last_window_end")


def late_metrics(classified: DataFrame) -> DataFrame:
    """One ``late_events_dropped = 1.0`` record per late event and branch
    (an event late for both branches counts twice, as in the reference).
    One pass: each event emits its 0-2 records from a filtered array."""
    def record(flag: str, name: str) -> Column:
        return F.struct(F.col(flag).alias("late"), F.lit(name).alias("branch"))

    records = F.filter(F.array(record("late_user_window", USER_BRANCH),
                               record("late_content_window", CONTENT_BRANCH)), lambda r: r["late"])
    return classified.select(F.inline(records), "event_id", "arrival_ts").select(
        F.lit(METRIC_LATE_EVENTS_DROPPED).alias("metric_name"),
        F.lit(1.0).alias("metric_value"),
        iso_micros("arrival_ts").alias("computed_at"),
        F.col("branch"),
        F.col("event_id"),
    )


def watermark_samples(events: DataFrame, event_time: str = "event_time", arrival_ts: str = "arrival_ts",
                      period_seconds: int = WATERMARK_SAMPLE_SECONDS) -> DataFrame:
    """``current_watermark`` metric per arrival period: max event time of all
    arrivals up to the period end - 30 s, in epoch ms; computed_at = period end."""
    p = floor_div(F.unix_micros(F.col(arrival_ts)), period_seconds * MICROS)
    per_period = (events.filter(F.col(event_time).isNotNull() & F.col(arrival_ts).isNotNull())
                  .groupBy(p.alias("p")).agg(F.max(event_time).alias("mx"))
                  .withColumn("_all", F.lit(0)))
    running = running_extreme(per_period, ["_all"], "p", "mx", "wm_src", F.max, descending=False)
    end_ts = F.timestamp_seconds((F.col("p") + 1) * F.lit(period_seconds))
    return running.select(
        F.lit(METRIC_CURRENT_WATERMARK).alias("metric_name"),
        (F.unix_millis("wm_src") - F.lit(WATERMARK_DELAY_SECONDS * 1000)).cast("double").alias("metric_value"),
        iso_micros(end_ts).alias("computed_at"),
        F.unix_micros(end_ts).alias("seq"),
    )


def metric_log(classified: DataFrame, events: DataFrame) -> DataFrame:
    """Append-only metric history: watermark samples and late-drop records,
    ordered by ``seq`` (emission time in micros)."""
    late = late_metrics(classified).select(
        "metric_name", "metric_value", "computed_at",
        F.unix_micros(F.to_timestamp("computed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("seq"))
    return watermark_samples(events).unionByName(late)


def late_share(classified: DataFrame) -> DataFrame:
    """One row: totals per branch and the late share in percent (0 if none)."""
    any_late = F.col("late_user_window") | F.col("late_content_window")
    return classified.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("late_user_window").alias("late_user_events"),
        F.count_if("late_content_window").alias("late_content_events"),
        F.count_if(any_late).alias("late_events"),
    ).select(
        "*",
        (F.col("late_user_events") + F.col("late_content_events")).alias("late_events_dropped"),
        (safe_rate(F.col("late_events"), F.col("total_events")) * F.lit(100.0)).alias("late_share_pct"),
    )


def divergence(events: DataFrame, table: DataFrame, event_time: str = "event_time",
               arrival: list[str] | None = None) -> DataFrame:
    """Batch (all events) versus stream (late rows dropped per window) values
    of the window features: rows where they differ, or where the stream never
    emitted the window. One pass: each event becomes its user-hour row and its
    three content-window rows, one broadcast join on (branch, k) attaches the
    earliest arrival for that window's end, and one aggregation counts all and
    kept events side by side (no join of two feature sets)."""
    arrival = arrival or ["arrival_ts", "event_id"]
    us = F.unix_micros(F.col(event_time))
    hour, slide = USER_WINDOW_SECONDS * MICROS, CONTENT_SLIDE_SECONDS * MICROS

    def row(family: str, branch: str, key: str, k: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), F.lit(branch).alias("branch"),
                        F.col(key).alias("key"), k.alias("k"))

    per_event = [row("u", USER_BRANCH, "user_id", floor_div(us, hour) + F.lit(1))]
    per_event += [row("c", CONTENT_BRANCH, "content_id", floor_div(us, slide) + F.lit(o))
                  for o in BRANCHES[CONTENT_BRANCH][1]]
    x = (events.filter(F.col(event_time).isNotNull())
         .select(F.inline(F.array(*per_event)), _arrival(arrival).alias("_a"),
                 is_type("event_type", EVENT_CLICK).alias("_click"), is_type("event_type", EVENT_VIEW).alias("_view"),
                 engaged("event_type").alias("_eng"), F.col("dwell_time_ms"))
         .filter(F.col("key").isNotNull()))
    t = table.select(F.col("branch").alias("_tb"), F.col("k").alias("_tk"), F.col("earliest"))
    x = x.join(t, (F.col("branch") == F.col("_tb")) & (F.col("k") == F.col("_tk")), "left")
    kept = ~F.coalesce(F.col("earliest") < F.col("_a"), F.lit(False))
    g = x.groupBy("family", "key", "k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_click").alias("c"), F.sum("dwell_time_ms").alias("d"),
        F.count_if("_view").alias("v"), F.count_if("_eng").alias("g"),
        F.count_if(kept).alias("nk"), F.count_if(kept & F.col("_click")).alias("ck"),
        F.sum(F.when(kept, F.col("dwell_time_ms")).otherwise(F.lit(0))).alias("dk"),
        F.count_if(kept & F.col("_view")).alias("vk"), F.count_if(kept & F.col("_eng")).alias("gk"),
    )
    nk = F.nullif(F.col("nk"), F.lit(0))
    user_values = F.array(
        F.struct(F.lit(CLICK_RATE).alias("feature_name"), (F.col("c") / F.col("n")).alias("batch_value"),
                 (F.col("ck") / nk).alias("stream_value")),
        F.struct(F.lit(AVG_DWELL_TIME).alias("feature_name"), (F.col("d") / F.col("n")).alias("batch_value"),
                 (F.col("dk") / nk).alias("stream_value")),
    )
    content_values = F.array(
        F.struct(F.lit(ENGAGEMENT_RATE).alias("feature_name"), safe_rate(F.col("g"), F.col("v")).alias("batch_value"),
                 F.when(F.col("nk") > 0, safe_rate(F.col("gk"), F.col("vk"))).alias("stream_value")),
    )
    is_user = F.col("family") == "u"
    end = F.timestamp_micros(F.col("k") * F.when(is_user, F.lit(hour)).otherwise(F.lit(slide)))
    rows = g.select(F.col("key").alias("entity_id"), end.alias("we"),
                    F.inline(F.when(is_user, user_values).otherwise(content_values)))
    return rows.filter(F.col("stream_value").isNull() | (F.col("stream_value") != F.col("batch_value"))).select(
        "entity_id", "feature_name", iso_seconds("we").alias("computed_at"),
        F.col("batch_value").cast("double").alias("batch_value"),
        F.col("stream_value").cast("double").alias("stream_value"),
        F.abs(F.col("batch_value") - F.col("stream_value")).cast("double").alias("abs_diff"),
    )


def compare_feature_sets(left: DataFrame, right: DataFrame, left_name: str = "batch_value",
                         right_name: str = "stream_value") -> DataFrame:
    """Rows where two feature sets disagree (value differs or one side lacks
    the window): a full outer join on (entity_id, feature_name, computed_at).
    Each key is unique on both sides, so no key is hot. Used to compare the
    streaming job's log with a batch recomputation."""
    keys = ["entity_id", "feature_name", "computed_at"]
    a = left.select(*keys, F.col("feature_value").alias(left_name))
    b = right.select(*keys, F.col("feature_value").alias(right_name))
    joined = a.join(b, keys, "full_outer")
    lv, rv = F.col(left_name), F.col(right_name)
    return joined.filter(~lv.eqNullSafe(rv)).select(
        *keys, lv, rv, F.abs(lv - rv).alias("abs_diff"))


def compare_feature_sets_stream(left: DataFrame, right: DataFrame, delay: str = "1 hour", left_name: str = "batch_value",
                                right_name: str = "stream_value") -> DataFrame:
    """:func:`compare_feature_sets` as windows close: a full outer join of two streams.

    Both sides are watermarked by their window's end, which is part of the key,
    so a row waits in the state until it is matched or the watermark (the newest
    window end less ``delay``, of the side that is behind) is past it; rows that the
    other side never has come out then. Start it with Spark's default for several
    watermarks (``min``), so that neither side is late for the other. The state is
    that of :mod:`eventide.operators.feature_join`.
    """
    def side(features: DataFrame) -> DataFrame:
        return features.select(F.col("entity_id").alias("id"), F.col("feature_name").alias("name"),
                               F.to_timestamp("computed_at", ISO_SECONDS).alias("end"),
                               F.col("feature_value").alias("value")).withWatermark("end", delay)

    joined = join_features(side(left), side(right))
    lv, rv = F.col("l"), F.col("r")
    return joined.filter(~lv.eqNullSafe(rv)).select(
        F.col("id").alias("entity_id"), F.col("name").alias("feature_name"), iso_seconds("end").alias("computed_at"),
        lv.alias(left_name), rv.alias(right_name), F.abs(lv - rv).alias("abs_diff"))
