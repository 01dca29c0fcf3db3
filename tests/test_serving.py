"""Serving views on a literal log (G6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import serving, store


def _log(spark):
    return spark.createDataFrame(
        [("u1", "click_rate", 0.2, "2026-01-01T11:00:00Z", 100.0, 0),
         ("u1", "click_rate", 0.5, "2026-01-01T12:00:00Z", 160.0, 0)],
        "entity_id string, feature_name string, feature_value double, computed_at string, received_at double, seq bigint")


def _metrics(spark):
    return spark.createDataFrame(
        [("current_watermark", 1767268770000.0, "x", 1), ("late_events_dropped", 1.0, "y", 2),
         ("late_events_dropped", 1.0, "z", 3)],
        "metric_name string, metric_value double, computed_at string, seq bigint")


def test_g6_report_lag_and_freshness(spark):
    log = _log(spark)
    latest = store.latest_features(log)
    report = serving.entity_report(serving.entity_lookup(latest, " u1 "), F.lit(163.4)).first()
    assert (report.value_text, report.age) == ("0.5000", "3s ago")
    just = serving.entity_report(serving.entity_lookup(latest, "u1"), F.lit(160.4)).first()
    assert just.age == "Just now"
    assert serving.entity_lookup(latest, "nobody").count() == 0
    state = serving.metric_state(_metrics(spark), log).first()
    assert (state.late_events_dropped, state.current_watermark) == (2, 1767268770000)
    lag = serving.watermark_lag(serving.metric_state(_metrics(spark), log)).first()
    assert lag.lag_text == "30.0s" and lag.watermark_clock == "11:59:30Z"
    fresh = {r.feature_name: r.age for r in serving.freshness(latest, F.lit(163.4)).collect()}
    assert fresh == {"click_rate": "3s ago", "engagement_rate": "--"}
    top = serving.recent_updates(log, 1).first()
    assert top.message == "Received feature: u1 | click_rate = 0.5000"
