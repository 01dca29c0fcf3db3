"""Property tests (hypothesis) over small random event sets."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.operators import affinity as aff
from eventide.operators import late
from eventide.operators import windows as win
from eventide.sources.changelog import metadata_snapshot
from fixtures import DAY, events, arrival_events
from conftest import rows

TYPES = ["view", "click", "like", "share", "error", "VIEW", None]
EVENT = st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["c1", "c2", "c3", "c4"]),
                  st.sampled_from(TYPES), st.integers(0, 5000), st.integers(0, 4 * 3600))
SETTINGS = settings(max_examples=5, deadline=None)


def _events(spark, spec):
    return events(spark, [(u, c, t, d, DAY + dt.timedelta(seconds=s)) for u, c, t, d, s in spec])


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_click_rate_in_unit_interval_and_one_pass_equal(spark, spec):
    ev = _events(spark, spec)
    feats = win.user_features(ev)
    rates = [r.feature_value for r in feats.filter(F.col("feature_name") == "click_rate").collect()]
    assert all(0.0 <= r <= 1.0 for r in rates)
    assert rows(win.window_features(ev)) == rows(win.window_features_one_pass(ev))


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_pane_form_equals_plain_sliding(spark, spec):
    ev = _events(spark, spec)
    assert rows(win.content_features(ev)) == rows(win.content_features_panes(ev))


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60), st.randoms(use_true_random=False))
def test_input_order_does_not_change_batch_features(spark, spec, rnd):
    shuffled = list(spec)
    rnd.shuffle(shuffled)
    a = _events(spark, spec)
    b = _events(spark, shuffled).repartition(3)
    assert rows(win.window_features(a)) == rows(win.window_features(b))


@SETTINGS
@given(st.lists(EVENT, min_size=1, max_size=60))
def test_affinity_sums_to_matched_events(spark, spec):
    ev = _events(spark, spec)
    meta = spark.createDataFrame(
        [("c1", "News", None, None, 1, False), ("c2", "Tech", None, None, 2, False), ("c3", "News", None, None, 3, False)],
        "content_id string, category string, creator_id string, publish_timestamp string, seq bigint, deleted boolean")
    f = aff.affinity_features(ev, metadata_snapshot(meta), F.lit("t"))
    per_user = {r.entity_id: r.s for r in f.groupBy("entity_id").agg(F.sum("feature_value").alias("s")).collect()}
    expected = {}
    for u, c, *_ in spec:
        if c in ("c1", "c2", "c3"):
            expected[u] = expected.get(u, 0) + 1
    assert per_user == {u: float(n) for u, n in expected.items()}


@SETTINGS
@given(st.lists(st.integers(0, 6 * 3600), min_size=1, max_size=50))
def test_in_order_arrival_has_no_late_rows(spark, seconds):
    times = sorted(DAY + dt.timedelta(seconds=s) for s in seconds)
    df = arrival_events(spark, [(i, "u", "c", "view", t, t) for i, t in enumerate(times)])
    c = late.classify(df)
    assert c.filter("late_user_window OR late_content_window").count() == 0
