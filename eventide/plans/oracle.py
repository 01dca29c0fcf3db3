"""DuckDB SQL equivalents of the registered batch plans.

The driver registers the raw tables as views; ``ev`` (shaped events) and
``meta`` (latest metadata) are inlined as CTEs. Every computed column is
aliased to the same name as on the Spark side.
"""

from __future__ import annotations

ISO_S = "'%Y-%m-%dT%H:%M:%SZ'"
ISO_US = "'%Y-%m-%dT%H:%M:%S.%fZ'"

EV = """ev AS (
  SELECT event_id,
    'usr_' || CAST(user_id AS VARCHAR) AS user_id,
    'cnt_' || json_extract_string(props, '$.k') AS content_id,
    CASE event_type WHEN 'purchase' THEN 'like' WHEN 'signup' THEN 'share' ELSE event_type END AS event_type,
    CASE WHEN event_type IN ('view', 'click') THEN CAST(round(value * 1000) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS dwell_time_ms,
    ts,
    ts + CASE WHEN event_id % 20 = 0 THEN to_minutes(CAST(35 + (event_id * 7) % 56 AS INTEGER)) ELSE to_minutes(0) END AS arrival_ts
  FROM events)"""

META = """meta AS (
  SELECT content_id, category, creator_id, publish_timestamp, seq FROM (
    SELECT 'cnt_' || CAST(p_partkey % 100 AS VARCHAR) AS content_id, p_type AS category,
      p_brand AS creator_id, CAST(NULL AS VARCHAR) AS publish_timestamp, p_partkey AS seq,
      row_number() OVER (PARTITION BY p_partkey % 100 ORDER BY p_partkey DESC) AS rn
    FROM part) q
  WHERE rn = 1)"""

USER_FEATURES = f"""uf AS (
  SELECT entity_id, f.feature_name AS feature_name, f.feature_value AS feature_value, computed_at FROM (
    SELECT user_id AS entity_id,
      strftime(ts + INTERVAL 1 HOUR, {ISO_S}) AS computed_at,
      unnest([struct_pack(feature_name := 'click_rate', feature_value := cr),
              struct_pack(feature_name := 'avg_dwell_time', feature_value := ad)]) AS f
    FROM (
      SELECT user_id, date_trunc('hour', ts) AS ts,
        CAST(count(*) FILTER (WHERE lower(event_type) = 'click') AS DOUBLE) / count(*) AS cr,
        CAST(sum(dwell_time_ms) AS DOUBLE) / count(*) AS ad
      FROM ev WHERE user_id IS NOT NULL AND ts IS NOT NULL
      GROUP BY user_id, date_trunc('hour', ts)) g) u)"""

CONTENT_FEATURES = f"""cf AS (
  SELECT content_id AS entity_id, 'engagement_rate' AS feature_name,
    coalesce(CAST(count(*) FILTER (WHERE lower(event_type) IN ('like', 'share')) AS DOUBLE)
      / nullif(count(*) FILTER (WHERE lower(event_type) = 'view'), 0), 0.0) AS feature_value,
    strftime(we, {ISO_S}) AS computed_at
  FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) + to_minutes(CAST(5 * unnest([1, 2, 3]) AS INTEGER)) AS we
        FROM ev
        WHERE content_id IS NOT NULL AND ts IS NOT NULL) x
  GROUP BY content_id, we)"""

AS_OF = "(SELECT date_trunc('second', max(ts)) FROM ev)"

AFFINITY = f"""af AS (
  SELECT ev.user_id AS entity_id, 'category_affinity_score:' || meta.category AS feature_name,
    CAST(count(*) AS DOUBLE) AS feature_value, strftime({AS_OF}, {ISO_S}) AS computed_at
  FROM ev JOIN meta ON ev.content_id = meta.content_id
  WHERE ev.user_id IS NOT NULL AND meta.category IS NOT NULL
  GROUP BY ev.user_id, meta.category)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {
    "events_shaped": with_(EV) + f"""SELECT event_id, user_id, content_id, event_type, dwell_time_ms,
  strftime(ts, {ISO_US}) AS event_time, strftime(arrival_ts, {ISO_US}) AS arrival_ts FROM ev""",
    "metadata_latest": with_(META) + "SELECT content_id, category, creator_id, publish_timestamp, seq FROM meta",
    "user_hourly_features": with_(EV, USER_FEATURES) + "SELECT * FROM uf",
    "content_sliding_features": with_(EV, CONTENT_FEATURES) + "SELECT * FROM cf",
    "content_sliding_panes": with_(EV, CONTENT_FEATURES) + "SELECT * FROM cf",
    "category_affinity": with_(EV, META, AFFINITY) + "SELECT * FROM af",
    "category_affinity_sql": with_(EV, META, AFFINITY) + "SELECT * FROM af",
    "all_features": with_(EV, META, USER_FEATURES, CONTENT_FEATURES, AFFINITY)
    + "SELECT * FROM uf UNION ALL SELECT * FROM cf UNION ALL SELECT * FROM af",
    "closed_windows_only": with_(EV, USER_FEATURES, CONTENT_FEATURES)
    + """SELECT * FROM (SELECT * FROM uf UNION ALL SELECT * FROM cf) f
WHERE strptime(computed_at, '%Y-%m-%dT%H:%M:%SZ') <= (SELECT max(ts) - INTERVAL 30 SECOND FROM ev)""",
}

# ---------------------------------------------------------------------------
# feature log, store, late data, serving
# ---------------------------------------------------------------------------
LOG = f"""log AS (
  SELECT entity_id, feature_name, feature_value, computed_at,
    CAST(epoch(strptime(computed_at, {ISO_S})) + 30 AS DOUBLE) AS received_at, CAST(0 AS BIGINT) AS seq
  FROM (SELECT * FROM uf UNION ALL SELECT * FROM cf) w
  UNION ALL
  SELECT entity_id, feature_name, feature_value, computed_at,
    CAST(epoch({AS_OF}) AS DOUBLE) AS received_at, CAST(0 AS BIGINT) AS seq
  FROM af)"""

LATEST = """latest AS (
  SELECT entity_id, feature_name, feature_value, computed_at, received_at, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, feature_name
                                 ORDER BY seq DESC, received_at DESC, computed_at DESC) AS rn
    FROM log
    WHERE entity_id IS NOT NULL AND entity_id <> '' AND feature_name IS NOT NULL AND feature_name <> '') q
  WHERE rn = 1)"""

NOW = "(SELECT max(received_at) FROM log)"

CLASSIFIED = """cl AS (
  SELECT *,
    coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= wm, false) AS late_user_window,
    coalesce(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 15 MINUTE <= wm, false) AS late_content_window,
    date_trunc('hour', ts) + INTERVAL 1 HOUR AS user_window_end,
    time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 15 MINUTE AS content_last_window_end
  FROM (SELECT *, max(ts) OVER (ORDER BY arrival_ts, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 SECOND AS wm
        FROM ev) x)"""

LATE_METRICS = f"""lm AS (
  SELECT 'late_events_dropped' AS metric_name, CAST(1.0 AS DOUBLE) AS metric_value,
    strftime(arrival_ts, {ISO_US}) AS computed_at, 'user_window' AS branch, event_id
  FROM cl WHERE late_user_window
  UNION ALL
  SELECT 'late_events_dropped', CAST(1.0 AS DOUBLE), strftime(arrival_ts, {ISO_US}), 'content_window', event_id
  FROM cl WHERE late_content_window)"""

WM_SAMPLES = f"""wms AS (
  SELECT 'current_watermark' AS metric_name,
    CAST(epoch_us(max(mx) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) // 1000 - 30000 AS DOUBLE) AS metric_value,
    strftime(make_timestamp((p + 1) * 300000000), {ISO_US}) AS computed_at,
    CAST((p + 1) * 300000000 AS BIGINT) AS seq
  FROM (SELECT epoch_us(arrival_ts) // 300000000 AS p, max(ts) AS mx FROM ev
        WHERE ts IS NOT NULL AND arrival_ts IS NOT NULL GROUP BY 1) g)"""

METRIC_LOG = f"""ml AS (
  SELECT metric_name, metric_value, computed_at, seq FROM wms
  UNION ALL
  SELECT metric_name, metric_value, computed_at, epoch_us(strptime(computed_at, '%Y-%m-%dT%H:%M:%S.%fZ')) AS seq FROM lm)"""

STATE = f"""st AS (
  SELECT
    CAST(coalesce(sum(CASE WHEN metric_name = 'late_events_dropped' THEN CAST(metric_value AS BIGINT) END), 0) AS BIGINT)
      AS late_events_dropped,
    CAST(coalesce(arg_max(metric_value, seq) FILTER (WHERE metric_name = 'current_watermark'), 0) AS BIGINT)
      AS current_watermark,
    CAST(coalesce((SELECT epoch_ms(strptime(computed_at, {ISO_S})) FROM log
                   WHERE NOT starts_with(feature_name, 'category_affinity_score:')
                   ORDER BY seq DESC, received_at DESC, computed_at DESC LIMIT 1), 0) AS BIGINT) AS last_sim_time
  FROM ml)"""


def _age(received: str, now: str = NOW) -> str:
    return (f"CASE WHEN {received} IS NULL OR {received} = 0 THEN '--' "
            f"WHEN floor({now} - {received}) < 1 THEN 'Just now' "
            f"ELSE CAST(CAST(floor({now} - {received}) AS BIGINT) AS VARCHAR) || 's ago' END")


def _late_rows(flag: str, end: str) -> str:
    return (f"SELECT event_id, user_id, content_id, event_type, strftime(ts, {ISO_US}) AS event_time, "
            f"strftime(arrival_ts, {ISO_US}) AS arrival_ts, strftime({end}, {ISO_S}) AS window_end "
            f"FROM cl WHERE {flag}")


DIVERGENCE = f"""ug AS (
  SELECT user_id AS entity_id, user_window_end AS we, count(*) AS n,
    count(*) FILTER (WHERE lower(event_type) = 'click') AS c, sum(dwell_time_ms) AS d,
    count(*) FILTER (WHERE NOT late_user_window) AS nk,
    count(*) FILTER (WHERE NOT late_user_window AND lower(event_type) = 'click') AS ck,
    sum(CASE WHEN NOT late_user_window THEN dwell_time_ms ELSE 0 END) AS dk
  FROM cl WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
ur AS (
  SELECT entity_id, we, 'click_rate' AS feature_name, CAST(c AS DOUBLE) / n AS batch_value,
    CAST(ck AS DOUBLE) / nullif(nk, 0) AS stream_value FROM ug
  UNION ALL
  SELECT entity_id, we, 'avg_dwell_time', CAST(d AS DOUBLE) / n, CAST(dk AS DOUBLE) / nullif(nk, 0) FROM ug),
cw AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) + to_minutes(CAST(5 * unnest([1, 2, 3]) AS INTEGER)) AS we
  FROM cl WHERE content_id IS NOT NULL AND ts IS NOT NULL),
cg AS (
  SELECT content_id AS entity_id, we,
    count(*) FILTER (WHERE lower(event_type) = 'view') AS v,
    count(*) FILTER (WHERE lower(event_type) IN ('like', 'share')) AS g,
    count(*) FILTER (WHERE NOT coalesce(we <= wm, false)) AS nk,
    count(*) FILTER (WHERE NOT coalesce(we <= wm, false) AND lower(event_type) = 'view') AS vk,
    count(*) FILTER (WHERE NOT coalesce(we <= wm, false) AND lower(event_type) IN ('like', 'share')) AS gk
  FROM cw GROUP BY 1, 2),
cr AS (
  SELECT entity_id, we, 'engagement_rate' AS feature_name,
    coalesce(CAST(g AS DOUBLE) / nullif(v, 0), 0.0) AS batch_value,
    CASE WHEN nk > 0 THEN coalesce(CAST(gk AS DOUBLE) / nullif(vk, 0), 0.0) END AS stream_value
  FROM cg)"""

PARSED = f"""SELECT event_id, user_id, content_id,
  CASE WHEN event_id % 7 = 5 THEN upper(event_type) ELSE event_type END AS event_type,
  CASE WHEN event_id % 7 = 4 THEN CAST(0 AS BIGINT) ELSE dwell_time_ms END AS dwell_time_ms,
  strftime(CASE WHEN event_id % 7 IN (0, 1) THEN {AS_OF} ELSE date_trunc('millisecond', ts) END,
           '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time
FROM ev"""

LAG = """SELECT current_watermark, last_sim_time,
  CASE WHEN current_watermark > 0 AND last_sim_time > 0 THEN last_sim_time - current_watermark END AS lag_ms,
  CASE WHEN current_watermark > 0 AND last_sim_time > 0 THEN
    (CASE WHEN last_sim_time - current_watermark < 0 THEN '-' ELSE '' END)
    || CAST((abs(last_sim_time - current_watermark) + 50) // 100 // 10 AS VARCHAR) || '.'
    || CAST(((abs(last_sim_time - current_watermark) + 50) // 100) % 10 AS VARCHAR) || 's'
  ELSE '--' END AS lag_text,
  CASE WHEN current_watermark > 0 THEN strftime(make_timestamp(current_watermark * 1000), '%H:%M:%SZ') END
    AS watermark_clock
FROM st"""

LOOKUP = "SELECT entity_id, feature_name, feature_value, computed_at, received_at FROM latest WHERE entity_id = trim(' usr_2 ')"

ALL_CORE = (EV, META, USER_FEATURES, CONTENT_FEATURES, AFFINITY, LOG)

SQL.update({
    "events_parsed": with_(EV) + PARSED,
    "feature_log_kv": with_(*ALL_CORE) + """SELECT entity_id || ':' || feature_name AS key,
  to_json(struct_pack(entity_id := entity_id, feature_name := feature_name,
                      feature_value := feature_value, computed_at := computed_at)) AS value FROM log""",
    "feature_store_latest": with_(*ALL_CORE, LATEST)
    + "SELECT entity_id, feature_name, feature_value, computed_at, received_at FROM latest",
    "late_user_events": with_(EV, CLASSIFIED) + _late_rows("late_user_window", "user_window_end"),
    "late_content_events": with_(EV, CLASSIFIED) + _late_rows("late_content_window", "content_last_window_end"),
    "late_metrics": with_(EV, CLASSIFIED, LATE_METRICS) + "SELECT * FROM lm",
    "watermark_metrics": with_(EV, WM_SAMPLES) + "SELECT * FROM wms",
    "metric_log": with_(EV, CLASSIFIED, LATE_METRICS, WM_SAMPLES, METRIC_LOG) + "SELECT * FROM ml",
    "late_share": with_(EV, CLASSIFIED) + """SELECT count(*) AS total_events,
  count(*) FILTER (WHERE late_user_window) AS late_user_events,
  count(*) FILTER (WHERE late_content_window) AS late_content_events,
  count(*) FILTER (WHERE late_user_window OR late_content_window) AS late_events,
  count(*) FILTER (WHERE late_user_window) + count(*) FILTER (WHERE late_content_window) AS late_events_dropped,
  coalesce(CAST(count(*) FILTER (WHERE late_user_window OR late_content_window) AS DOUBLE) / nullif(count(*), 0), 0.0)
    * 100.0 AS late_share_pct
FROM cl""",
    "batch_stream_divergence": with_(EV, CLASSIFIED, DIVERGENCE) + f"""SELECT entity_id, feature_name,
  strftime(we, {ISO_S}) AS computed_at, batch_value, stream_value, abs(batch_value - stream_value) AS abs_diff
FROM (SELECT * FROM ur UNION ALL SELECT * FROM cr) x
WHERE stream_value IS NULL OR stream_value <> batch_value""",
    "metric_state": with_(*ALL_CORE, CLASSIFIED, LATE_METRICS, WM_SAMPLES, METRIC_LOG, STATE) + "SELECT * FROM st",
    "watermark_lag": with_(*ALL_CORE, CLASSIFIED, LATE_METRICS, WM_SAMPLES, METRIC_LOG, STATE) + LAG,
    "entity_lookup": with_(*ALL_CORE, LATEST) + LOOKUP,
    "stored_lookup": with_(*ALL_CORE, LATEST) + LOOKUP,
    "entity_report": with_(*ALL_CORE, LATEST) + f"""SELECT entity_id, feature_name,
  printf('%.4f', feature_value) AS value_text, computed_at, {_age('received_at')} AS age
FROM ({LOOKUP}) l""",
    "freshness": with_(*ALL_CORE, LATEST) + f"""SELECT feature_name, last_received_at, {_age('last_received_at')} AS age
FROM (SELECT 'click_rate' AS feature_name,
        max(received_at) FILTER (WHERE feature_name = 'click_rate') AS last_received_at FROM latest
      UNION ALL
      SELECT 'engagement_rate', max(received_at) FILTER (WHERE feature_name = 'engagement_rate') FROM latest) f""",
    "recent_updates": with_(*ALL_CORE) + """SELECT received_at, entity_id, feature_name, feature_value, computed_at,
  'Received feature: ' || entity_id || ' | ' || feature_name || ' = ' || coalesce(printf('%.4f', feature_value), 'null')
    AS message
FROM log ORDER BY received_at DESC, seq DESC, computed_at DESC, entity_id ASC, feature_name ASC LIMIT 50""",
})

# ---------------------------------------------------------------------------
# JSON documents and messages, and the logs read back
# ---------------------------------------------------------------------------
DOCUMENTS = """docs AS (
  SELECT entity_id, count(*) AS n_features,
    '{' || string_agg('"' || feature_name || '":' || CAST(to_json(struct_pack(value := feature_value,
      computed_at := computed_at, received_at := CAST(received_at * 1000 AS BIGINT))) AS VARCHAR), ',' ORDER BY feature_name)
      || '}' AS document
  FROM latest GROUP BY entity_id)"""

RUNNING = f"""changes AS (
  SELECT seq, CASE WHEN metric_name = 'late_events_dropped' THEN CAST(metric_value AS BIGINT) END AS late,
    CASE WHEN metric_name = 'current_watermark' THEN CAST(metric_value AS BIGINT) END AS wm, CAST(NULL AS BIGINT) AS sim
  FROM ml
  UNION ALL
  SELECT CAST(received_at * 1000000 AS BIGINT), NULL, NULL, epoch_ms(strptime(computed_at, {ISO_S}))
  FROM log WHERE NOT starts_with(feature_name, 'category_affinity_score:')),
running AS (
  SELECT DISTINCT seq,
    CAST(coalesce(sum(late) OVER w, 0) AS BIGINT) AS late_events_dropped,
    CAST(coalesce(max(wm) OVER w, 0) AS BIGINT) AS current_watermark,
    CAST(coalesce(max(sim) OVER w, 0) AS BIGINT) AS last_sim_time
  FROM changes WINDOW w AS (ORDER BY seq RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

METRICS = (CLASSIFIED, LATE_METRICS, WM_SAMPLES, METRIC_LOG)

SQL.update({
    "entity_documents": with_(*ALL_CORE, LATEST, DOCUMENTS) + "SELECT entity_id, n_features, document FROM docs",
    "state_snapshot": with_(*ALL_CORE, LATEST, DOCUMENTS, *METRICS, STATE) + """SELECT 'state_dump' AS type, 'features' AS part,
  entity_id, document FROM docs
UNION ALL
SELECT 'state_dump', 'metrics', NULL, CAST(to_json(struct_pack(late_events_dropped := late_events_dropped,
  current_watermark := current_watermark, last_sim_time := last_sim_time)) AS VARCHAR) FROM st""",
    "change_feed": with_(*ALL_CORE, *METRICS, RUNNING) + """SELECT received_at AS at, seq,
  CAST(to_json(struct_pack(type := 'feature_update', entity_id := entity_id, feature_name := feature_name,
    data := struct_pack(value := feature_value, computed_at := computed_at,
                        received_at := CAST(received_at * 1000 AS BIGINT)))) AS VARCHAR) AS message
FROM log
UNION ALL
SELECT CAST(ml.seq AS DOUBLE) / 1000000.0, ml.seq, CAST(to_json(struct_pack(type := 'metrics_update',
  late_events_dropped := late_events_dropped, current_watermark := current_watermark, last_sim_time := last_sim_time)) AS VARCHAR)
FROM ml JOIN running ON ml.seq = running.seq""",
    "metric_log_kv": with_(EV, *METRICS) + "SELECT metric_name AS key, metric_name, metric_value, computed_at FROM ml",
    "serving_reader": with_(*ALL_CORE, *METRICS, STATE) + "SELECT (SELECT count(*) FROM log) AS n_features, * FROM st",
    "events_published": with_(EV) + """SELECT user_id AS key, count(*) AS n, CAST(sum(dwell_time_ms) AS BIGINT) AS dwell_time_ms,
  strftime(max(date_trunc('millisecond', ts)), '%Y-%m-%dT%H:%M:%S.%gZ') AS last_event_time FROM ev GROUP BY user_id""",
    "changelog_rowkinds": "SELECT 'cnt_' || CAST(p_partkey % 100 AS VARCHAR) AS content_id, p_type AS category, p_partkey AS seq FROM part",
})

# ---------------------------------------------------------------------------
# the streaming job in pieces
# ---------------------------------------------------------------------------
#: Events with the watermark that held when their piece came (times in milliseconds, as the job has them).
PIECES = """pieces AS (
  SELECT *, least(CAST(floor((epoch_us(arrival_ts) - a) * 3.0 / (b - a + 1)) AS INTEGER) + CAST(event_id % 20 = 0 AS INTEGER), 2) AS piece
  FROM ev, (SELECT epoch_us(min(arrival_ts)) AS a, epoch_us(max(arrival_ts)) AS b FROM ev) s
), marks AS (
  SELECT x.piece, max(epoch_ms(y.ts)) - 30000 AS wm
  FROM (SELECT DISTINCT piece FROM pieces) x JOIN pieces y ON y.piece < x.piece GROUP BY x.piece
), marked AS (
  SELECT p.*, m.wm, epoch_ms(date_trunc('hour', ts)) + 3600000 AS hour_end,
    epoch_ms(time_bucket(INTERVAL 5 MINUTE, ts)) + 900000 AS last_end
  FROM pieces p LEFT JOIN marks m ON p.piece = m.piece
)"""

#: Windows as the stream has them: without rows that came behind the watermark of their piece, and only closed ones.
EMITTED = f"""uw AS (
  SELECT user_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS we, lower(event_type) AS kind, dwell_time_ms,
    coalesce(hour_end > wm, true) AS kept
  FROM marked WHERE user_id IS NOT NULL
), cw AS (
  SELECT content_id, we, kind, coalesce(epoch_ms(we) > wm, true) AS kept FROM (
    SELECT content_id, wm, lower(event_type) AS kind,
      time_bucket(INTERVAL 5 MINUTE, ts) + to_minutes(CAST(5 * unnest([1, 2, 3]) AS INTEGER)) AS we
    FROM marked WHERE content_id IS NOT NULL) x
), ug AS (
  SELECT user_id AS entity_id, we, count(*) AS n, count(*) FILTER (WHERE kind = 'click') AS c, sum(dwell_time_ms) AS d,
    count(*) FILTER (WHERE kept) AS nk, count(*) FILTER (WHERE kept AND kind = 'click') AS ck,
    sum(dwell_time_ms) FILTER (WHERE kept) AS dk
  FROM uw GROUP BY user_id, we
), cg AS (
  SELECT content_id AS entity_id, we, count(*) FILTER (WHERE kind IN ('like', 'share')) AS g, count(*) FILTER (WHERE kind = 'view') AS v,
    count(*) FILTER (WHERE kept) AS nk, count(*) FILTER (WHERE kept AND kind IN ('like', 'share')) AS gk,
    count(*) FILTER (WHERE kept AND kind = 'view') AS vk
  FROM cw GROUP BY content_id, we
), both_sides AS (
  SELECT entity_id, 'click_rate' AS feature_name, we, CAST(c AS DOUBLE) / n AS batch_value, CAST(ck AS DOUBLE) / nullif(nk, 0) AS kept_value FROM ug
  UNION ALL
  SELECT entity_id, 'avg_dwell_time', we, CAST(d AS DOUBLE) / n, CAST(dk AS DOUBLE) / nullif(nk, 0) FROM ug
  UNION ALL
  SELECT entity_id, 'engagement_rate', we, coalesce(CAST(g AS DOUBLE) / nullif(v, 0), 0.0),
    CASE WHEN nk > 0 THEN coalesce(CAST(gk AS DOUBLE) / nullif(vk, 0), 0.0) END FROM cg
), compared AS (
  SELECT entity_id, feature_name, we, batch_value,
    CASE WHEN epoch_ms(we) <= (SELECT max(epoch_ms(ts)) - 30000 FROM ev) THEN kept_value END AS stream_value
  FROM both_sides
)"""

SQL.update({
    "streamed_windows": SQL["closed_windows_only"],
    "streamed_windows_sql": SQL["closed_windows_only"],
    "streamed_late_metrics": with_(EV, PIECES) + """SELECT branch, CAST(count(*) AS BIGINT) AS late_events FROM (
  SELECT 'user_window' AS branch FROM marked WHERE user_id IS NOT NULL AND hour_end <= wm
  UNION ALL
  SELECT 'content_window' FROM marked WHERE content_id IS NOT NULL AND last_end <= wm) x
GROUP BY branch""",
    # a window that the stream never emitted comes out once the join's watermark, an hour behind the newest window end, is past it
    "streamed_divergence": with_(EV, PIECES, EMITTED) + f"""SELECT entity_id, feature_name, strftime(we, {ISO_S}) AS computed_at,
  batch_value, stream_value, abs(batch_value - stream_value) AS abs_diff
FROM compared
WHERE stream_value <> batch_value
  OR (stream_value IS NULL AND epoch_ms(we) <= (SELECT max(epoch_ms(we)) - 3600000 FROM compared))""",
    "streamed_affinity": with_(EV, META, AFFINITY) + "SELECT entity_id, feature_name, feature_value FROM af",
})
