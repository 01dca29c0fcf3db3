"""Watermark observability: a ``current_watermark`` metric from query progress.

Spark reports the event-time watermark of each micro-batch in the progress
event; the listener turns it into a metric record, at most once per 5 s of
wall clock, and skips progress without a watermark yet.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

from eventide.config import METRIC_CURRENT_WATERMARK, WATERMARK_METRIC_PERIOD_MS


def _epoch_ms(iso: str) -> int | None:
    try:
        t = dt.datetime.fromisoformat(iso.replace("Z", "+00:00"))
    except (TypeError, ValueError):
        return None
    return int(t.timestamp() * 1000)


class WatermarkMetricListener(StreamingQueryListener):
    """Keeps the most recent records in memory (a bounded buffer on the
    driver) and hands every record to ``on_record`` when given, e.g. to
    publish it to the metrics topic. The durable records are those of the window
    query; this only observes."""

    def __init__(self, query_name: str | None = None, period_ms: int = WATERMARK_METRIC_PERIOD_MS,
                 on_record: Callable[[tuple[str, float, str]], None] | None = None, keep: int = 10_000):
        self.query_name = query_name
        self.period_ms = period_ms
        self.on_record = on_record
        self.records: deque[tuple[str, float, str]] = deque(maxlen=keep)
        self._last_emit = 0.0
        self._lock = threading.Lock()

    def onQueryStarted(self, event):  # noqa: N802 - Spark API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        if self.query_name and p.name != self.query_name:
            return
        wm = _epoch_ms((p.eventTime or {}).get("watermark"))
        if wm is None or wm <= 0:
            return
        now = time.time() * 1000
        with self._lock:
            if now - self._last_emit <= self.period_ms:
                return
            self._last_emit = now
            stamp = dt.datetime.now(dt.timezone.utc).isoformat().replace("+00:00", "Z")
            record = (METRIC_CURRENT_WATERMARK, float(wm), stamp)
            self.records.append(record)
        if self.on_record is not None:
            self.on_record(record)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
