"""Tables of the streaming job, and how its queries are started."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.config import CHECKPOINT_INTERVAL
from eventide.schemas import FEATURE_COLUMNS
from eventide.session import SESSION_DEFAULTS, checkpoint_root, prepare

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Layout:
    """Output tables of the job under one root folder."""

    root: str

    @property
    def events(self) -> str:
        """Every message, parsed (file sink)."""
        return f"{self.root}/events"

    @property
    def features(self) -> str:
        """Window records by batch."""
        return f"{self.root}/features"

    @property
    def moves(self) -> str:
        """Differences of (user, category) counts (file sink)."""
        return f"{self.root}/moves"

    @property
    def affinity(self) -> str:
        """Affinity records by batch."""
        return f"{self.root}/affinity"

    @property
    def metrics(self) -> str:
        """Metric records by batch."""
        return f"{self.root}/metrics"

    @property
    def clock(self) -> str:
        """What was observed while each batch of the window query was written: one row a batch."""
        return f"{self.root}/clock"


def prepare_streaming(spark: SparkSession) -> None:
    """Session settings that the queries need."""
    prepare(spark)
    # rows must be tested against the watermark of the batch they arrive in
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(key, SESSION_DEFAULTS[key])
    # lifetime counts and open windows live off-heap in RocksDB; each
    # checkpoint uploads a changelog instead of a full snapshot. A provider
    # chosen by the cluster is kept (it is fixed per checkpoint anyway).
    provider = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if spark.conf.get(provider, default) == default:
        spark.conf.set(provider, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def started(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def started_with(spark: SparkSession, setting: str, value: str, writer, trigger: dict | None) -> StreamingQuery:
    """Start a query with a setting of its own: a query keeps the settings that it was started with."""
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        return started(writer, trigger)
    finally:
        spark.conf.set(setting, before)


def checkpoint_of(spark: SparkSession, name: str, location: str | None, layout: Layout) -> str:
    """Explicit location, else ``<spark.checkpoint.dir>/streams/<job key>/<query>``
    where the job key is derived from the output root: a restarted job
    resumes its own state, two jobs never share one."""
    if location:
        return location
    job_key = hashlib.sha1(layout.root.encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/streams/{job_key}/{name}"


def table_stream(spark: SparkSession, table: str, schema: T.StructType | str, files_per_batch: int | None = None,
                 partitioned: bool = False) -> DataFrame:
    """A table as a stream, also before its first batch. Tables with a folder per batch are
    read below their folders; their ``batch_id`` is no column."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    reader = spark.readStream.schema(schema)
    if not partitioned:
        reader = reader.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(table)


def log_rows(df: DataFrame, batch_id: int, now_ms: int | None = None) -> DataFrame:
    """Feature records as rows of the log, received now or at the given time."""
    now = F.unix_micros(F.current_timestamp()) / F.lit(1_000_000.0) if now_ms is None else F.lit(now_ms / 1000)
    return df.select(*FEATURE_COLUMNS, now.alias("received_at"), F.lit(batch_id).cast("bigint").alias("seq"))
