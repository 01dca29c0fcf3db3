"""Window features, affinity and the store on literal fixtures (G1-G3, D-rules)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import affinity as aff
from eventide.operators import store
from eventide.operators import windows as win
from eventide.sources.changelog import latest_per_key, metadata_snapshot
from fixtures import at, events
from conftest import rows


def test_g1_user_window(spark):
    ev = events(spark, [("u1", "c1", "view", 3000, at("10:05")), ("u1", "c1", "CLICK", 1000, at("10:20")),
                        ("u1", "c1", "like", 0, at("10:40")), ("u1", "c1", "click", 500, at("11:00"))])
    got = {(r.feature_name, r.computed_at): r.feature_value for r in win.user_features(ev).collect()}
    assert got == {
        ("click_rate", "2026-01-01T11:00:00Z"): 1 / 3,
        ("avg_dwell_time", "2026-01-01T11:00:00Z"): 4000 / 3,
        ("click_rate", "2026-01-01T12:00:00Z"): 1.0,
        ("avg_dwell_time", "2026-01-01T12:00:00Z"): 500.0,
    }


def test_g2_content_window_and_pane_form(spark):
    ev = events(spark, [("u1", "c1", "view", 10, at("10:02")), ("u2", "c1", "like", 0, at("10:04")),
                        ("u3", "c1", "share", 0, at("10:07"))])
    expected = {"2026-01-01T10:05:00Z": 1.0, "2026-01-01T10:10:00Z": 2.0,
                "2026-01-01T10:15:00Z": 2.0, "2026-01-01T10:20:00Z": 0.0}
    for fn in (win.content_features, win.content_features_panes):
        got = {r.computed_at: r.feature_value for r in fn(ev).collect()}
        assert got == expected


def test_null_keys_and_types_are_not_counted(spark):
    ev = events(spark, [(None, "c1", "click", 5, at("10:00")), ("u1", None, None, 7, at("10:01")),
                        ("u1", "c1", "Click", 0, at("10:02"))])
    users = {(r.entity_id, r.feature_name): r.feature_value for r in win.user_features(ev).collect()}
    # NULL user dropped; NULL type counts in totals only; case folded
    assert users == {("u1", "click_rate"): 0.5, ("u1", "avg_dwell_time"): 3.5}
    assert {r.entity_id for r in win.content_features(ev).collect()} == {"c1"}


def _meta(spark, rows_):
    return spark.createDataFrame(
        rows_, "content_id string, category string, creator_id string, publish_timestamp string, seq bigint, "
               "deleted boolean")


def test_g3_affinity_batch(spark):
    ev = events(spark, [("u1", c, "view", 0, at("10:00")) for c in ("c1", "c1", "c2", "c9")])
    meta = _meta(spark, [("c1", "News", None, None, 1, False), ("c2", "Tech", None, None, 2, False)])
    f = aff.affinity_features(ev, metadata_snapshot(meta), F.lit("t"))
    assert rows(f, "feature_name", "feature_value") == [
        ("category_affinity_score:News", 2.0), ("category_affinity_score:Tech", 1.0)]
    meta2 = meta.unionByName(_meta(spark, [("c1", "Tech", None, None, 3, False), ("c9", None, None, None, 4, False)]))
    f2 = aff.affinity_features(ev, metadata_snapshot(meta2), F.lit("t"))
    # c1 re-attributed to Tech; NULL category gives no feature
    assert rows(f2, "feature_name", "feature_value") == [("category_affinity_score:Tech", 3.0)]


def test_changelog_latest_and_tombstone(spark):
    meta = _meta(spark, [("c1", "A", None, None, 1, False), ("c1", "B", None, None, 5, False),
                         ("c2", "C", None, None, 2, False), ("c2", None, None, None, 3, True)])
    snap = metadata_snapshot(meta)
    assert rows(snap, "content_id", "category", "seq") == [("c1", "B", 5)]
    assert latest_per_key(meta, ["content_id"], deleted=None).count() == 2


def test_store_latest_and_documents(spark):
    log = spark.createDataFrame(
        [("u1", "click_rate", 0.2, "2026-01-01T11:00:00Z", 100.0, 0),
         ("u1", "click_rate", 0.5, "2026-01-01T12:00:00Z", 160.0, 0),
         ("u1", "", 1.0, "x", 1.0, 0), ("", "click_rate", 1.0, "x", 1.0, 0)],
        "entity_id string, feature_name string, feature_value double, computed_at string, received_at double, seq bigint")
    latest = store.latest_features(log)
    assert rows(latest, "entity_id", "feature_name", "feature_value") == [("u1", "click_rate", 0.5)]
    doc = store.entity_documents(latest).first()
    assert doc.document == ('{"click_rate":{"value":0.5,"computed_at":"2026-01-01T12:00:00Z",'
                            '"received_at":160000}}')
    kv = store.feature_kv(latest.select("entity_id", "feature_name", "feature_value", "computed_at")).first()
    assert kv.key == "u1:click_rate"
