"""Structured Streaming queries on file streams, one file per micro-batch."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from eventide.streaming import queries as q
from eventide.streaming.affinity import start_affinity, start_moves
from eventide.streaming.ingest import event_table, quarantine, start_ingest
from eventide.streaming.job import start_job
from eventide.streaming.sinks import read_table
from eventide.streaming.sources import file_stream, metadata_stream_files
from conftest import rows

NOW = {"availableNow": True}

DAY = "2026-01-01"


_CLOCK = [time.time() - 10_000]


def _write_lines(folder, name, records):
    """Write one JSON-lines file; file streams order files by modification
    time, so every file gets a strictly later mtime than the previous one."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n")
    _CLOCK[0] += 2
    os.utime(path, (_CLOCK[0], _CLOCK[0]))


def _ev(user, content, etype, hhmmss, dwell=1000):
    return {"user_id": user, "content_id": content, "event_type": etype,
            "dwell_time_ms": dwell, "timestamp": f"{DAY}T{hhmmss}Z"}


def _drain(query):
    query.awaitTermination()
    return query


def _ingest(spark, src, layout, files=1, mode="FAILFAST"):
    return _drain(start_ingest(file_stream(spark, str(src), max_files_per_trigger=files), layout, mode,
                               checkpoint=layout.root + "-ck-ingest", trigger=NOW))


def _windows(spark, src, layout, files=1):
    """Ingest one file a batch, then the window query, ``files`` files of the event table a batch."""
    _ingest(spark, src, layout)
    return _drain(q.start_window_features(event_table(spark, layout, files_per_batch=files), layout,
                                          checkpoint=layout.root + "-ck-windows", trigger=NOW))


def _affinity(spark, src, meta, layout, emit_zero=False, files=None):
    """Ingest, moves and totals until everything has come through; the latest value per (entity, feature)."""
    _ingest(spark, src, layout)
    moves = _drain(start_moves(event_table(spark, layout, watermark=False, files_per_batch=files),
                               metadata_stream_files(spark, str(meta)), layout,
                               checkpoint=layout.root + "-ck-moves", trigger=NOW))
    totals = _drain(start_affinity(spark, layout, checkpoint=layout.root + "-ck-totals", trigger=NOW, emit_zero=emit_zero))
    latest = (q.feature_log(spark, layout).groupBy("entity_id", "feature_name").agg(F.max_by("feature_value", "seq").alias("v")))
    return {(r.entity_id, r.feature_name.rpartition(":")[2]): r.v for r in latest.collect()}, moves, totals


def _meta(folder, name, records):
    """Changelog messages (content, category or None for a delete, offset[, partition])."""
    _write_lines(folder, name, [
        {"key": c, "value": None if cat is None else json.dumps({"content_id": c, "category": cat}), "offset": off,
         "partition": part[0] if part else 0} for c, cat, off, *part in records])


@pytest.fixture()
def lateness_files(tmp_path):
    """G4: [00:58:00], [01:00:30], [00:59:59, 00:59:58], [00:59:57, 00:59:56], [03:00:00]."""
    src = tmp_path / "events"
    batches = [
        [_ev("u1", "c1", "click", "00:58:00")],
        [_ev("u1", "c1", "view", "01:00:30")],
        [_ev("u1", "c1", "like", "00:59:59"), _ev("u1", "c1", "like", "00:59:58")],
        [_ev("u1", "c1", "like", "00:59:57"), _ev("u1", "c1", "like", "00:59:56")],
        [_ev("u1", "c1", "view", "03:00:00")],
    ]
    for i, b in enumerate(batches):
        _write_lines(src, f"part-{i:03d}.json", b)
    return src


def test_window_features_append_drops_late_rows(spark, tmp_path, lateness_files):
    layout = q.Layout(str(tmp_path / "out"))
    _windows(spark, lateness_files, layout)
    log = q.feature_log(spark, layout)
    got = {(r.entity_id, r.feature_name, r.computed_at): r.feature_value for r in log.collect()}
    # hour [00:00, 01:00) closed with only 00:58 counted: the four 00:59:5x rows are late
    assert got[("u1", "click_rate", f"{DAY}T01:00:00Z")] == 1.0
    assert got[("u1", "click_rate", f"{DAY}T02:00:00Z")] == 0.0
    # sliding windows: late for the window ending 01:00 only; counted in 01:05 and 01:10
    assert got[("c1", "engagement_rate", f"{DAY}T01:00:00Z")] == 0.0
    assert got[("c1", "engagement_rate", f"{DAY}T01:05:00Z")] == 4.0
    assert got[("c1", "engagement_rate", f"{DAY}T01:10:00Z")] == 4.0
    assert got[("c1", "engagement_rate", f"{DAY}T01:15:00Z")] == 0.0
    # windows of 03:00 are still open (no final flush)
    assert not any(k[2] > f"{DAY}T03:00:00Z" for k in got)
    m = q.metric_log(spark, layout)
    late = m.filter(F.col("metric_name") == "late_events_dropped")
    assert late.filter(F.col("branch") == "user_window").count() == 4
    assert late.filter(F.col("branch") == "content_window").count() == 0


def test_watermarks_are_those_of_the_windows(spark, tmp_path, lateness_files):
    """The watermark kept for each batch is the one that Spark reports for it; samples are 5 s apart at least."""
    layout = q.Layout(str(tmp_path / "out"))
    query = _windows(spark, lateness_files, layout)
    clock = {r.batch_id: r.watermark_ms for r in read_table(spark, layout.clock).collect()}
    reported = {}
    for p in query.recentProgress:
        mark = dt.datetime.fromisoformat(p.eventTime["watermark"].replace("Z", "+00:00")) if "watermark" in p.eventTime else None
        reported[p.batchId] = int(mark.timestamp() * 1000) if mark and mark.timestamp() > 0 else None
    assert {b: clock[b] for b in reported} == reported and len(set(clock.values())) >= 4
    assert max(w for w in clock.values() if w) == 1767236370000  # the newest event less 30 s
    samples = q.metric_log(spark, layout).filter("metric_name = 'current_watermark'")
    assert 1 <= samples.count() <= len(clock)
    times = sorted(dt.datetime.fromisoformat(r.computed_at.replace("Z", "+00:00")) for r in samples.collect())
    assert all((b - a).total_seconds() > 5 for a, b in zip(times, times[1:], strict=False))


@pytest.mark.parametrize("files", [1, 3])
def test_late_counts_are_what_the_windows_dropped(spark, tmp_path, files):
    """sf0.001 events in 8 files, some of them late, taken one or three at a time: leaving out exactly the rows
    behind their batch's watermark gives the hourly windows of the query, and so many records it wrote."""
    from eventide.operators import windows as win
    from eventide.plans import batch
    from conftest import SF001

    ev = batch.events(spark, SF001).orderBy("arrival_ts", "event_id").collect()
    src = tmp_path / "events"
    size = (len(ev) + 7) // 8
    chunks = [[] for _ in range(8)]
    for i, r in enumerate(ev):  # every ninth event comes one or two files late
        chunks[min(i // size + (1 + r.event_id % 2 if r.event_id % 9 == 0 else 0), 7)].append(r)
    for i, chunk in enumerate(chunks):
        _write_lines(src, f"p-{i:03d}.json", [
            {"user_id": None if r.event_id % 50 == 7 else r.user_id, "content_id": None if r.event_id % 50 == 8 else r.content_id,
             "event_type": r.event_type, "dwell_time_ms": r.dwell_time_ms,
             "timestamp": r.event_time.strftime("%Y-%m-%dT%H:%M:%S.%f") + "Z"} for r in chunk])
    layout = q.Layout(str(tmp_path / "out"))
    _windows(spark, src, layout, files)
    got = q.feature_log(spark, layout)

    delay, kept, high = dt.timedelta(seconds=30), [], None
    late = {"user_window": 0, "content_window": 0}
    for first in range(0, len(chunks), files):
        cut = [r for chunk in chunks[first:first + files] for r in chunk]
        for r in cut:
            t = r.event_time.replace(microsecond=r.event_time.microsecond // 1000 * 1000)  # as the parser does
            slot = t.replace(minute=t.minute // 5 * 5, second=0, microsecond=0)
            user = None if r.event_id % 50 == 7 else r.user_id
            content = None if r.event_id % 50 == 8 else r.content_id
            behind = lambda end: high is not None and end <= high - delay  # noqa: B023, E731
            late_user = behind(t.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1))
            late["user_window"] += late_user and user is not None
            late["content_window"] += behind(slot + dt.timedelta(minutes=15)) and content is not None
            if not late_user:
                kept.append((user, content, r.event_type, r.dwell_time_ms, t))
        top = max(r.event_time.replace(microsecond=r.event_time.microsecond // 1000 * 1000) for r in cut)
        high = top if high is None else max(high, top)
    expected = win.user_features(spark.createDataFrame(
        kept, "user_id string, content_id string, event_type string, dwell_time_ms bigint, event_time timestamp"))
    expected = expected.filter(F.to_timestamp("computed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'") <= F.lit(high - delay))
    cols = ("entity_id", "feature_name", "computed_at", "feature_value")
    hourly = got.filter(F.col("feature_name").isin("click_rate", "avg_dwell_time"))
    assert rows(hourly, *cols) == rows(expected, *cols) and hourly.count() > 100
    counted = q.metric_log(spark, layout).filter("metric_name = 'late_events_dropped'").groupBy("branch").count()
    assert {r.branch: r["count"] for r in counted.collect()} == {k: n for k, n in late.items() if n}
    assert min(late.values()) > 20


def test_affinity_reattributes_on_metadata_change(spark, tmp_path):
    """G3: c1 -> News, c2 -> Tech; u1 views c1, c1, c2, c9 (unknown). Each run restarts all queries from their checkpoints."""
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    _meta(meta, "m-0.json", [("c1", "News", 1), ("c2", "Tech", 2)])
    _write_lines(ev, "e-000.json", [_ev("u1", c, "view", "10:00:00") for c in ("c1", "c1", "c2", "c9")])
    got, *_ = _affinity(spark, ev, meta, layout)
    assert got == {("u1", "News"): 2.0, ("u1", "Tech"): 1.0}

    _meta(meta, "m-1.json", [("c1", "Tech", 3)])
    _write_lines(ev, "e-001.json", [_ev("u2", "c2", "view", "10:01:00")])
    got, *_ = _affinity(spark, ev, meta, layout)
    assert got[("u1", "Tech")] == 3.0
    assert got[("u1", "News")] == 2.0   # stale value stays (retractions dropped)
    assert got[("u2", "Tech")] == 1.0

    _meta(meta, "m-2.json", [("c9", "News", 4)])
    _write_lines(ev, "e-002.json", [_ev("u2", "c2", "view", "10:02:00")])
    got, *_ = _affinity(spark, ev, meta, layout)
    assert got == {("u1", "News"): 1.0, ("u1", "Tech"): 3.0, ("u2", "Tech"): 2.0}

    _meta(meta, "m-3.json", [("c2", None, 5)])  # a delete takes its counts away; later events wait for a category
    _write_lines(ev, "e-003.json", [_ev("u2", "c2", "view", "10:03:00"), _ev("u3", "c1", "view", "10:03:00")])
    got, *_ = _affinity(spark, ev, meta, layout, emit_zero=True)
    assert got == {("u1", "News"): 1.0, ("u1", "Tech"): 2.0, ("u2", "Tech"): 0.0, ("u3", "Tech"): 1.0}


def test_a_batch_costs_what_it_changes(spark, tmp_path):
    """Differences written, and state rows updated, follow the pairs of the batch, not what is stored."""
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    _meta(meta, "m.json", [("c1", "News", 1)])
    for i in range(3):
        _write_lines(ev, f"e-{i:03d}.json", [_ev(f"u{k}", "c1", "view", f"10:0{i}:00") for k in range(40)] * (i + 1))
    got, moves, _ = _affinity(spark, ev, meta, layout, files=1)
    assert set(got.values()) == {6.0} and len(got) == 40
    assert spark.read.parquet(layout.moves).count() == 3 * 40
    _write_lines(ev, "e-009.json", [_ev("u7", "c1", "view", "10:09:00")] * 5)
    got, moves, totals = _affinity(spark, ev, meta, layout, files=1)
    assert got[("u7", "News")] == 11.0 and spark.read.parquet(layout.moves).count() == 3 * 40 + 1
    assert [p.stateOperators[0].numRowsUpdated for p in totals.recentProgress if p.numInputRows] == [1]
    assert spark.read.parquet(f"{layout.affinity}/batch_id={totals.recentProgress[-1].batchId}").count() <= 1


def test_state_holds_many_users_in_a_value(spark, tmp_path):
    """Users of one content come in three batches; their counts move with its category and lie in few state rows."""
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    users = ["ü\"\\ 1"] + [f"u{i}" for i in range(5000)]
    _meta(meta, "m-0.json", [("c1", "News", i) for i in range(50)] + [("c2", "Tech", 1)])
    kept = []
    for i, some in enumerate((users[:600], users, users[:1])):
        _write_lines(ev, f"e-{i}.json", [_ev(u, "c1", "view", "10:00:00") for u in some])
        _ingest(spark, ev, layout)
        moves = _drain(start_moves(event_table(spark, layout, watermark=False), metadata_stream_files(spark, str(meta)), layout,
                                   checkpoint=layout.root + "-ck-moves", trigger=NOW, shares=1))
        kept += [p.stateOperators[0].numRowsTotal for p in moves.recentProgress if p.numInputRows]
        if i == 1:
            _meta(meta, "m-1.json", [("c1", "Sport", 90), ("c1", "Old", 80)])
    assert kept[0] < kept[1] <= 2 * len(users) / 500 and kept[2] == kept[1]
    totals = spark.read.parquet(layout.moves).groupBy("user_id", "category").agg(F.sum("n").alias("n")).filter("n != 0")
    assert rows(totals, "user_id", "category", "n") == sorted(
        (u, "Sport", 1 + (i < 600) + (i < 1)) for i, u in enumerate(users))


def test_metadata_partitions_and_old_offsets(spark, tmp_path):
    """Offsets order a content's rows within its partition; another partition's may be far ahead."""
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    _meta(meta, "m-0.json", [("c1", "A", 100, 0), ("c2", "A", 5, 1)])
    _write_lines(ev, "e-0.json", [_ev("u", c, "view", "10:00:00") for c in ("c1", "c2", "c2", "c3")])
    _affinity(spark, ev, meta, layout)
    _meta(meta, "m-1.json", [("c2", "B", 6, 1), ("c3", "C", 7, 1), ("c1", "Z", 99, 0)])  # the last is older than what is known
    _write_lines(ev, "e-1.json", [_ev("u", c, "view", "10:01:00") for c in ("c1", "c2", "c2", "c3")])
    got, *_ = _affinity(spark, ev, meta, layout)
    assert got == {("u", "A"): 2.0, ("u", "B"): 4.0, ("u", "C"): 2.0}


def test_affinity_with_only_null_keys(spark, tmp_path):
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    _meta(meta, "m.json", [("c1", "News", 1)])
    _write_lines(ev, "e-0.json", [{"content_id": "c1", "event_type": "view", "timestamp": f"{DAY}T10:00:00Z"}])
    _write_lines(ev, "e-1.json", [_ev("u1", "c1", "view", "10:01:00")])
    got, *_ = _affinity(spark, ev, meta, layout, files=1)
    assert got == {("u1", "News"): 1.0}


def test_affinity_emit_zero_retracts_to_zero(spark, tmp_path):
    """D14 option: with emit_zero, a (user, category) that loses all events is
    written as 0.0 instead of keeping its stale value."""
    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    _meta(meta, "m-0.json", [("c1", "News", 1)])
    _write_lines(ev, "e-0.json", [_ev("u1", "c1", "view", "10:00:00")] * 2)
    assert _affinity(spark, ev, meta, layout, emit_zero=True)[0] == {("u1", "News"): 2.0}
    _meta(meta, "m-1.json", [("c1", "Tech", 2)])
    _write_lines(ev, "e-1.json", [_ev("u9", "c1", "view", "10:05:00")])
    got, *_ = _affinity(spark, ev, meta, layout, emit_zero=True)
    assert got == {("u1", "News"): 0.0, ("u1", "Tech"): 2.0, ("u9", "Tech"): 1.0}


def test_streamed_affinity_equals_batch(spark, tmp_path):
    """sf0.001 events and changelog in interleaved pieces: the totals are those of the batch operator."""
    from eventide.operators import affinity as aff
    from eventide.plans import batch
    from eventide.sources import testdata
    from conftest import SF001

    ev, meta = tmp_path / "events", tmp_path / "meta"
    layout = q.Layout(str(tmp_path / "out"))
    events = batch.events(spark, SF001).orderBy("arrival_ts", "event_id").select("user_id", "content_id").collect()
    log = testdata.metadata_changelog(spark, SF001).orderBy("seq").collect()
    for i in range(2):
        _meta(meta, f"m-{i}.json", [(r.content_id, None if r.deleted else r.category, r.seq) for r in log[i::2]])
        _write_lines(ev, f"e-{i}.json", [_ev(r.user_id, r.content_id, "view", "10:00:00") for r in events[i::2]])
        got, *_ = _affinity(spark, ev, meta, layout, emit_zero=True)
    want = aff.affinity_counts(aff.pair_counts(batch.events(spark, SF001)), batch.metadata_latest(spark, SF001))
    assert {k: v for k, v in got.items() if v} == {(r.user_id, r.category): float(r.n) for r in want.collect()}


def test_job_with_listener_and_latest_values(spark, tmp_path, lateness_files):
    from eventide.streaming.latest import latest_checkpoint, read_latest

    meta = tmp_path / "meta"
    _meta(meta, "m.json", [("c1", "News", 1)])
    raw = file_stream(spark, str(lateness_files), max_files_per_trigger=1)

    def run():
        job = start_job(spark, raw, metadata_stream_files(spark, str(meta)), str(tmp_path / "out"), trigger=NOW, latest=True,
                        files_per_batch=1)
        job.drain()
        job.stop()
        return job

    job = run()
    where = latest_checkpoint(spark, job.layout)
    latest = {(r.entity_id, r.feature_name): r.feature_value for r in read_latest(spark, where).collect()}
    assert latest[("u1", "category_affinity_score:News")] == 7.0
    assert latest[("u1", "click_rate")] == 0.0           # newest closed hour: 02:00
    assert latest[("c1", "engagement_rate")] == 0.0      # newest closed window: 01:15
    assert q.metric_log(spark, job.layout).filter("metric_name = 'late_events_dropped'").count() == 4
    assert any(name == "current_watermark" and value > 0 for name, value, _ in job.listener.records)

    # a restart of all queries goes on from their checkpoints; older versions stay readable
    _write_lines(lateness_files, "part-009.json", [_ev("u1", "c1", "view", "05:00:00")])
    run()
    assert rows(read_latest(spark, where, " c1 "), "entity_id", "feature_name") == [("c1", "engagement_rate")]
    now = {(r.entity_id, r.feature_name): r.feature_value for r in read_latest(spark, where, "u1").collect()}
    assert now[("u1", "category_affinity_score:News")] == 8.0
    then = read_latest(spark, where, "u1", version=0).filter("feature_name like 'category%'").first()
    assert then.feature_value == 7.0
    assert read_latest(spark, where, "nobody").count() == 0


def test_continuous_job_reads_and_parses_once(spark, tmp_path, lateness_files):
    """With a processing-time trigger all queries run side by side; only the ingest reads the raw source."""
    meta = tmp_path / "meta"
    _meta(meta, "m.json", [("c1", "News", 1)])
    raw = file_stream(spark, str(lateness_files), max_files_per_trigger=1)
    job = start_job(spark, raw, metadata_stream_files(spark, str(meta)), str(tmp_path / "out"), trigger={"processingTime": "0 seconds"})
    try:
        job.drain()
        names = {query.name for query in job.queries}
        sources = {query.name: str([s.description for p in query.recentProgress for s in p.sources]) for query in job.queries}
    finally:
        job.stop()
    assert names == {"ingest", "window_features", "category_moves", "category_affinity"}
    assert [n for n, read in sources.items() if str(lateness_files) in read] == ["ingest"]
    got = q.feature_log(spark, job.layout).filter("feature_name like 'category%'").agg(F.max("feature_value")).first()[0]
    assert got == 7.0


def test_restart_from_checkpoint_continues(spark, tmp_path):
    """Stop after two files, add three more, restart on the same checkpoint:
    the output equals one uninterrupted run."""
    src = tmp_path / "events"
    times = ["00:58:00", "01:00:30", "00:59:59", "02:10:00", "03:00:00"]
    kinds = ["click", "view", "like", "view", "view"]
    for i in range(2):
        _write_lines(src, f"p-{i}.json", [_ev("u1", "c1", kinds[i], times[i])])
    split = q.Layout(str(tmp_path / "split"))
    _windows(spark, src, split)
    for i in range(2, 5):
        _write_lines(src, f"p-{i}.json", [_ev("u1", "c1", kinds[i], times[i])])
    _windows(spark, src, split)
    whole = q.Layout(str(tmp_path / "whole"))
    _windows(spark, src, whole)
    cols = ("entity_id", "feature_name", "feature_value", "computed_at")
    assert rows(q.feature_log(spark, split), *cols) == rows(q.feature_log(spark, whole), *cols)
    assert q.feature_log(spark, split).count() > 0
    late = [q.metric_log(spark, x).filter("metric_name = 'late_events_dropped'").count() for x in (split, whole)]
    assert late == [1, 1]


def test_change_feed_stream_reads_feature_log(spark, tmp_path, lateness_files):
    layout = q.Layout(str(tmp_path / "out"))
    _windows(spark, lateness_files, layout)
    feed = q.change_feed_stream(spark, layout)
    _drain(feed.writeStream.format("memory").queryName("feed_out")
           .option("checkpointLocation", str(tmp_path / "ck-feed")).trigger(availableNow=True).start())
    messages = [json.loads(r.message) for r in spark.table("feed_out").collect()]
    assert len(messages) == q.feature_log(spark, layout).count() > 0
    assert all(m["type"] == "feature_update" and "value" in m["data"] for m in messages)


def test_permissive_ingest_keeps_malformed_json_apart(spark, tmp_path):
    src, meta = tmp_path / "events", tmp_path / "meta"
    _meta(meta, "m.json", [("c1", "News", 1)])
    src.mkdir()
    (src / "p.json").write_text(json.dumps(_ev("u1", "c1", "view", "10:00:00")) + "\n{broken\n")
    job = start_job(spark, file_stream(spark, str(src)), metadata_stream_files(spark, str(meta)), str(tmp_path / "out"),
                    trigger=NOW, mode="PERMISSIVE")
    job.drain()
    job.stop()
    assert [r.value for r in quarantine(spark, job.layout).collect()] == ["{broken"]
    aff = q.feature_log(spark, job.layout).filter(F.col("feature_name").startswith("category"))
    assert [r.feature_value for r in aff.collect()] == [1.0]


def test_failfast_ingest_stops_on_malformed_json(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    (src / "p.json").write_text("{broken\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|[Mm]alformed"):
        _ingest(spark, src, q.Layout(str(tmp_path / "out")))


def test_window_features_by_sql_on_a_stream(spark, tmp_path, lateness_files):
    """A streaming frame as a temporary view: Spark SQL and DataFrame forms write equal logs."""
    from eventide.operators.windows import window_features, window_features_sql

    layout = q.Layout(str(tmp_path / "out"))
    _ingest(spark, lateness_files, layout)
    q.prepare_streaming(spark)
    for name, form in (("by_sql", window_features_sql), ("by_frame", window_features)):
        frame = form(event_table(spark, layout, files_per_batch=1))
        assert frame.isStreaming
        _drain(frame.writeStream.format("memory").queryName(name).outputMode("append")
               .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
    assert rows(spark.table("by_sql")) == rows(spark.table("by_frame")) and spark.table("by_sql").count() >= 6


def test_backfill_compares_with_stream_output(spark, tmp_path, lateness_files):
    """Batch recomputation vs the streaming job on G4: the only differences are
    the closed hour that dropped late rows and windows the stream has not
    closed yet."""
    from eventide.plans.backfill import run

    meta = tmp_path / "meta"
    _meta(meta, "m.json", [("c1", "News", 1)])
    raw = file_stream(spark, str(lateness_files), max_files_per_trigger=1)
    job = start_job(spark, raw, metadata_stream_files(spark, str(meta)), str(tmp_path / "stream"), trigger=NOW, files_per_batch=1)
    job.drain()
    job.stop()
    # the same events and metadata as tables
    events_pq, meta_pq = str(tmp_path / "events.parquet"), str(tmp_path / "meta.parquet")
    spark.read.text(str(lateness_files)).write.parquet(events_pq)
    spark.read.json(str(meta)).write.parquet(meta_pq)
    run(spark, events_pq, meta_pq, str(tmp_path / "backfill"), stream_out=str(tmp_path / "stream"))
    div = {(r.entity_id, r.feature_name, r.computed_at): (r.batch_value, r.stream_value)
           for r in spark.read.parquet(str(tmp_path / "backfill" / "divergence")).collect()}
    # hour ending 01:00: batch counts the four late likes (1 click of 5 events), the stream only the click
    assert div[("u1", "click_rate", f"{DAY}T01:00:00Z")] == (0.2, 1.0)
    # windows after the last watermark exist only in the batch
    assert all(s is None for (_, _, t), (_, s) in div.items() if t > f"{DAY}T03:00:00Z")
    latest = spark.read.parquet(str(tmp_path / "backfill" / "latest"))
    assert latest.filter("feature_name = 'category_affinity_score:News'").first().feature_value == 7.0


def test_metric_state_stream(spark, tmp_path, lateness_files):
    layout = q.Layout(str(tmp_path / "out"))
    _windows(spark, lateness_files, layout)
    _drain(q.metric_state_stream(spark, layout).writeStream.outputMode("complete").format("memory")
           .queryName("metric_state_out").option("checkpointLocation", str(tmp_path / "ck-state"))
           .trigger(availableNow=True).start())
    row = spark.table("metric_state_out").first()
    assert row.late_events_dropped == 4
    newest = q.metric_log(spark, layout).filter("metric_name = 'current_watermark'").agg(F.max("metric_value")).first()[0]
    assert row.current_watermark == newest and row.last_sim_time == 1767232800000  # 02:00, the last closed hour


def test_divergence_of_streams_as_windows_close(spark, tmp_path):
    """Differing values come out when both sides have come, rows of one side once the watermark is past them;
    what is matched or past leaves the state."""
    from eventide.operators.late import compare_feature_sets_stream
    from eventide.schemas import FEATURE_RECORD
    from eventide.streaming.tables import table_stream

    left, right, out = (str(tmp_path / x) for x in ("left", "right", "out"))
    q.prepare_streaming(spark)

    def add(table, *records):
        spark.createDataFrame(records, FEATURE_RECORD).coalesce(1).write.mode("append").parquet(table)

    def run():
        joined = compare_feature_sets_stream(table_stream(spark, left, FEATURE_RECORD), table_stream(spark, right, FEATURE_RECORD))
        query = _drain(joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
                       .trigger(availableNow=True).start())
        got = {(r.entity_id, r.computed_at): (r.batch_value, r.stream_value, r.abs_diff) for r in spark.read.parquet(out).collect()}
        return got, query.recentProgress[-1].stateOperators[0].numRowsTotal

    at = lambda hour: f"{DAY}T{hour:02d}:00:00Z"
    add(left, ("a", "click_rate", 0.5, at(1)), ("b", "click_rate", 0.5, at(1)), ("c", "click_rate", 1.0, at(1)))
    add(right, ("a", "click_rate", 0.5, at(1)), ("b", "click_rate", 0.25, at(1)), ("d", "click_rate", 2.0, at(1)))
    got, _ = run()
    assert got == {("b", at(1)): (0.5, 0.25, 0.25)}  # c and d may still be matched
    for side in (left, right):  # one side runs ahead: nothing is late for the other
        for hour in range(2, 9):
            add(side, ("a", "click_rate", 0.5, at(hour)))
            if hour in (4, 8):
                got, kept = run()
    for side in (left, right):
        add(side, ("a", "click_rate", 0.5, at(9)))
    got, kept = run()
    assert got == {("b", at(1)): (0.5, 0.25, 0.25), ("c", at(1)): (1.0, None, None), ("d", at(1)): (None, 2.0, None)}
    assert kept <= 6  # of 20 rows: those of the last windows


def test_divergence_state_is_packed_and_rows_meet_over_batches(spark, tmp_path):
    """The state has an entry for an hour and share, not for each row; rows of a window that come in several batches,
    twice or without a name meet all those of the other side."""
    from eventide.operators.feature_join import SHARES
    from eventide.operators.late import compare_feature_sets_stream
    from eventide.schemas import FEATURE_RECORD
    from eventide.streaming.tables import table_stream

    left, right, out = (str(tmp_path / x) for x in ("left", "right", "out"))
    q.prepare_streaming(spark)
    at = f"{DAY}T01:00:00Z"
    many = [(f"u{i}", "click_rate", 0.5, at) for i in range(100)]

    def run(**sides):
        for table, records in sides.items():
            spark.createDataFrame(records, FEATURE_RECORD).coalesce(1).write.mode("append").parquet(str(tmp_path / table))
        joined = compare_feature_sets_stream(table_stream(spark, left, FEATURE_RECORD), table_stream(spark, right, FEATURE_RECORD))
        query = _drain(joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
                       .trigger(availableNow=True).start())
        got = sorted(((r.entity_id, r.feature_name, r.batch_value, r.stream_value) for r in spark.read.parquet(out).collect()), key=str)
        return got, query.recentProgress[-1].stateOperators[0].numRowsTotal

    none, nan = (None, "a", 1.0, at), ("n", "a", float("nan"), at)
    got, kept = run(left=[*many, none, nan, ("x", "a", 1.0, at)], right=many[:50] + [(None, "a", 2.0, at), nan, ("x", "a", 1.0, at)])
    assert got == [(None, "a", 1.0, 2.0)] and kept <= SHARES  # 203 rows
    got, _ = run(left=[("x", "a", 3.0, at)], right=[*many[50:], ("x", "a", 4.0, at), ("y", "a", None, at), ("z", "a", 0.0, at)])
    met = [("x", "a", 1.0, 4.0), ("x", "a", 3.0, 1.0), ("x", "a", 3.0, 4.0), (None, "a", 1.0, 2.0)]
    assert got == sorted(met, key=str)
    later = [("u", "click_rate", 0.5, f"{DAY}T02:00:00Z")]  # the watermark is at the window's end: it is past
    got, kept = run(left=later, right=later)
    assert got == sorted([*met, ("z", "a", None, 0.0)], key=str) and kept == 1


def test_serving_state_without_reading_a_log(spark, tmp_path, lateness_files):
    """What was observed while the logs were written is what the logs say."""
    from eventide.operators import serving

    layout = q.Layout(str(tmp_path / "out"))
    assert q.serving_state(spark, layout) is None and q.observed_freshness(spark, layout, F.lit(0.0)) is None
    _windows(spark, lateness_files, layout)
    log, now = q.feature_log(spark, layout), F.lit(time.time())
    want = serving.metric_state(q.metric_log(spark, layout), log).first().asDict()
    got = q.serving_state(spark, layout)
    assert got.first().asDict() == {k: want[k] for k in got.columns} and want["late_events_dropped"] == 4
    assert q.observed_freshness(spark, layout, now).collect() == serving.freshness(log, now).collect()
    assert not any("/features/" in f or "/metrics/" in f for f in got.inputFiles())
