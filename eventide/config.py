"""Constants and runtime configuration.

Fixed values: these must equal the reference pipeline's for identical results.
They are stated once here, in natural order, and imported everywhere else.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (semantics of the reference pipeline)
# ---------------------------------------------------------------------------
WATERMARK_DELAY = "30 seconds"          # bounded out-of-orderness
WATERMARK_DELAY_SECONDS = 30
USER_WINDOW = "1 hour"                  # tumbling, per user
USER_WINDOW_SECONDS = 3600
CONTENT_WINDOW = "15 minutes"           # sliding, per content
CONTENT_WINDOW_SECONDS = 900
CONTENT_SLIDE = "5 minutes"
CONTENT_SLIDE_SECONDS = 300
CHECKPOINT_INTERVAL = "10 seconds"
WATERMARK_METRIC_PERIOD_MS = 5000       # watermark metric emitted at most this often

CLICK_RATE = "click_rate"
AVG_DWELL_TIME = "avg_dwell_time"
ENGAGEMENT_RATE = "engagement_rate"
AFFINITY_PREFIX = "category_affinity_score:"

METRIC_CURRENT_WATERMARK = "current_watermark"
METRIC_LATE_EVENTS_DROPPED = "late_events_dropped"

EVENT_CLICK = "click"
EVENT_VIEW = "view"
EVENT_LIKE = "like"
EVENT_SHARE = "share"

FEED_FEATURE_UPDATE = "feature_update"
FEED_METRICS_UPDATE = "metrics_update"
FEED_STATE_DUMP = "state_dump"

RECENT_UPDATES_CAP = 50                 # console feed keeps the newest 50 lines

# ISO-8601 instant, whole seconds, UTC ("2026-01-01T11:00:00Z")
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# ISO-8601 instant with microseconds, used for event/arrival times in outputs
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Accepted shape of an event timestamp: an instant with a Z suffix
ISO_INSTANT_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?[Zz]$"

# ---------------------------------------------------------------------------
# Tunables (not semantics)
# ---------------------------------------------------------------------------
# The threshold table of the late classifier is broadcast only when its row
# count is proven to be at most this many rows (of a fixed width); beyond it
# the join is left to a shuffle join.
MAX_BROADCAST_ROWS = 2_000_000
# Slots per block in the two-level suffix minimum of the late classifier.
SLOT_BLOCK = 4096


def _env(name: str, default: str) -> str:
    value = os.environ.get(name)
    return value if value else default


@dataclass(frozen=True)
class PipelineConfig:
    """Source/sink locations. Environment names follow the reference job."""

    bootstrap_servers: str = "kafka:29092"
    user_events_topic: str = "user-events"
    content_metadata_topic: str = "content-metadata"
    feature_store_topic: str = "feature-store"
    metrics_topic: str = "flink-metrics"
    metadata_partitions: int = 1            # of the metadata topic
    consumer_group: str = "feature-pipeline-group"
    starting_offsets: str = "earliest"
    kafka_options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls) -> "PipelineConfig":
        d = cls()
        return cls(
            bootstrap_servers=_env("KAFKA_BOOTSTRAP_SERVERS", d.bootstrap_servers),
            user_events_topic=_env("KAFKA_TOPIC_USER_EVENTS", d.user_events_topic),
            content_metadata_topic=_env("KAFKA_TOPIC_CONTENT_METADATA", d.content_metadata_topic),
            feature_store_topic=_env("KAFKA_TOPIC_FEATURE_STORE", d.feature_store_topic),
            metrics_topic=_env("KAFKA_TOPIC_METRICS", d.metrics_topic),
        )

    def kafka_reader_options(self, topic: str) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            # a prefix only: queries that share one group id would each get part of the data
            "groupIdPrefix": self.consumer_group,
        }
        opts.update(self.kafka_options)
        return opts

    def kafka_writer_options(self, topic: str) -> dict[str, str]:
        opts = {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": topic}
        opts.update(self.kafka_options)
        return opts
