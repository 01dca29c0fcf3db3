"""JSON parsing rules (G5, D1-D7)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventide.sources.events_json import parse_events, split_malformed

FALLBACK = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)


def _parse(spark, values, mode="FAILFAST"):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return parse_events(raw, mode=mode, keep=["i"], fallback_time=F.lit(FALLBACK), skip_empty=True)


def test_g5_timestamps_dwell_and_unknown_fields(spark):
    vals = [
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5,"timestamp":"2026-06-13T10:00:00Z"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5,"timestamp":"2026-06-13T10:00:00.123456Z"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5,"timestamp":"2026-06-13T10:00:00"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5,"timestamp":"2026-06-13T10:00:00+02:00"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5,"timestamp":"junk"}',
        '{"user_id":"u","content_id":"c","event_type":"view","timestamp":"2026-06-13t10:00:00z","extra":1}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":"12","timestamp":"2026-06-13T10:00:00Z"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":12.7,"timestamp":"2026-06-13T10:00:00Z"}',
        '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":5}',
        "",
    ]
    got = {r.i: r for r in _parse(spark, vals).collect()}
    accepted = dt.datetime(2026, 6, 13, 10, 0)
    fallback = FALLBACK.replace(tzinfo=None)
    assert got[0].event_time == accepted
    assert got[1].event_time == accepted.replace(microsecond=123000)
    assert [got[i].event_time for i in (2, 3, 4, 8)] == [fallback] * 4
    assert got[5].event_time == accepted and got[5].dwell_time_ms == 0
    assert got[6].dwell_time_ms == 12 and got[7].dwell_time_ms == 12
    assert 9 not in got  # empty message dropped


def test_junk_dwell_fails_or_is_quarantined(spark):
    row = '{"user_id":"u","content_id":"c","event_type":"view","dwell_time_ms":%s,"timestamp":"2026-06-13T10:00:00Z"}'
    for junk in ('"x"', "1e30", "true"):
        with pytest.raises(Exception, match="dwell_time_ms"):
            _parse(spark, [row % junk]).collect()
    good, bad = split_malformed(_parse(spark, [row % x for x in ('"x"', "1e30", "null", "7")], mode="PERMISSIVE"))
    assert sorted(r.dwell_time_ms for r in good.collect()) == [0, 7] and bad.count() == 2


def test_malformed_json_failfast_and_quarantine(spark):
    vals = ['{"user_id":"u","timestamp":"2026-06-13T10:00:00Z"}', "{not json"]
    with pytest.raises(Exception):
        _parse(spark, vals).collect()
    good, bad = split_malformed(_parse(spark, vals, mode="PERMISSIVE"))
    assert good.count() == 1 and bad.count() == 1
