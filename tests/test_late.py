"""Late classification: distributed suffix-minimum form against a brute-force replay."""

from __future__ import annotations

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators import late
from fixtures import DAY, arrival_events


def brute_force(rows):
    """rows: (event_id, ts, arrival). Returns {event_id: (late_user, late_content)}."""
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    out, mx = {}, None
    for eid, ts, _ in order:
        wm = None if mx is None else mx - dt.timedelta(seconds=30)
        hour_end = ts.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
        slide = ts.replace(minute=ts.minute - ts.minute % 5, second=0, microsecond=0)
        last_end = slide + dt.timedelta(minutes=15)
        out[eid] = (wm is not None and hour_end <= wm, wm is not None and last_end <= wm)
        mx = ts if mx is None else max(mx, ts)
    return out


def _frame(spark, rows):
    return arrival_events(spark, [(eid, "u", "c", "view", ts, arr) for eid, ts, arr in rows])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6 * 3600), st.integers(0, 5400)), min_size=1, max_size=40),
       st.randoms(use_true_random=False))
def test_classifier_matches_replay(spark, spec, rnd):
    rows = []
    for i, (t, delay) in enumerate(spec):
        ts = DAY + dt.timedelta(seconds=t)
        rows.append((i, ts, ts + dt.timedelta(seconds=delay if rnd.random() < 0.3 else 0)))
    got = {r.event_id: (r.late_user_window, r.late_content_window)
           for r in late.classify(_frame(spark, rows)).collect()}
    assert got == brute_force(rows)


def test_g4_replay_counts(spark):
    t = [("00:58:00"), ("01:00:30"), ("00:59:59"), ("00:59:58"), ("00:59:57"), ("00:59:56"), ("03:00:00")]
    rows = []
    for i, s in enumerate(t):
        h, m, sec = map(int, s.split(":"))
        ts = DAY.replace(hour=h, minute=m, second=sec)
        rows.append((i, ts, DAY + dt.timedelta(seconds=i)))
    c = late.classify(_frame(spark, rows))
    assert c.filter("late_user_window").count() == 4
    assert c.filter("late_content_window").count() == 0
    share = late.late_share(c).first()
    assert share.late_events == 4 and abs(share.late_share_pct - 400 / 7) < 1e-9


def test_running_extreme_across_blocks(spark):
    random.seed(7)
    vals = [(k, random.randint(0, 1000)) for k in range(50)]
    df = spark.createDataFrame([("p", k, v) for k, v in vals], "part string, k bigint, v bigint")
    got = {r.k: r.out for r in late.running_extreme(df, ["part"], "k", "v", "out", F.min, True, block=3).collect()}
    assert got == {k: min(v for kk, v in vals if kk >= k) for k, _ in vals}
    got = {r.k: r.out for r in late.running_extreme(df, ["part"], "k", "v", "out", F.max, False, block=4).collect()}
    assert got == {k: max(v for kk, v in vals if kk <= k) for k, _ in vals}


def test_compare_feature_sets(spark):
    schema = "entity_id string, feature_name string, computed_at string, feature_value double"
    a = spark.createDataFrame([("u", "f", "t1", 1.0), ("u", "f", "t2", 2.0), ("u", "f", "t3", 3.0)], schema)
    b = spark.createDataFrame([("u", "f", "t1", 1.0), ("u", "f", "t2", 2.5), ("u", "f", "t4", 4.0)], schema)
    got = {r.computed_at: (r.batch_value, r.stream_value, r.abs_diff)
           for r in late.compare_feature_sets(a, b).collect()}
    assert got == {"t2": (2.0, 2.5, 0.5), "t3": (3.0, None, None), "t4": (None, 4.0, None)}
