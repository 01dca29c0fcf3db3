"""Idempotent micro-batch sinks.

A micro-batch is written to ``<table>/batch_id=<id>`` with overwrite, so a
replay of the same batch after a failure replaces its own output instead of
duplicating it (exactly-once on a file system). Readers see the table as
one parquet dataset with a ``batch_id`` column, which doubles as write order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.config import PipelineConfig
from eventide.operators.store import feature_kv, metric_kv


def write_batch(df: DataFrame, table: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table.rstrip('/')}/batch_id={batch_id}")


def read_table(spark: SparkSession, table: str, upto_batch: int | None = None) -> DataFrame | None:
    """All batches of a table, or None before the first one. Any other failure of a read is raised."""
    if not has_data(spark, table):
        return None
    df = spark.read.option("basePath", table).parquet(table)
    if upto_batch is not None:
        df = df.filter(F.col("batch_id") <= upto_batch)
    return df


def kafka_features(df: DataFrame, cfg: PipelineConfig) -> None:
    """Feature records -> compacted feature topic, key ``entity_id:feature_name``."""
    feature_kv(df).write.format("kafka").options(**cfg.kafka_writer_options(cfg.feature_store_topic)).save()


def kafka_metrics(df: DataFrame, cfg: PipelineConfig) -> None:
    """Metric records -> metrics topic, key = metric name."""
    metric_kv(df).write.format("kafka").options(**cfg.kafka_writer_options(cfg.metrics_topic)).save()


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """The subset of ``paths`` that exist, checked through Hadoop's FileSystem
    (works for any cluster store, not only local disk)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            out.append(p)
    return out


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder exists and holds any Parquet file, at any depth (batches may be empty)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    files = fs.listFiles(path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_batches(spark: SparkSession, table: str, batch_ids: list[int]) -> DataFrame | None:
    """Rows of the given batches only: explicit folders, so the listing cost
    does not grow with the number of batches ever written."""
    paths = existing_paths(spark, [f"{table.rstrip('/')}/batch_id={b}" for b in batch_ids])
    paths = [p for p in paths if has_data(spark, p)]  # a partitioned write of no rows leaves no file
    return spark.read.option("basePath", table).parquet(*paths) if paths else None


def read_previous(spark: SparkSession, table: str, batch_id: int) -> DataFrame | None:
    """The previous batch's rows when it wrote any, else all earlier batches
    (first batch after a gap or a restart)."""
    prev = read_batches(spark, table, [batch_id - 1]) if batch_id > 0 else None
    return prev if prev is not None else read_table(spark, table, upto_batch=batch_id - 1)


def batch_ids(spark: SparkSession, table: str) -> list[int]:
    """Ids of the batches that a table has, in order: a listing of names only."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]
    return sorted(int(name[9:]) for name in names if name.startswith("batch_id=") and name[9:].isdigit())


def newest_batches(spark: SparkSession, table: str, rows: int) -> DataFrame | None:
    """The newest batches of a table that have at least ``rows`` rows together, or all: older ones are not opened.

    Batches are counted from their files' footers, the newest first, twice as many each time."""
    ids, taken = batch_ids(spark, table), 0
    while taken < len(ids):
        taken = max(1, 2 * taken)
        found = read_batches(spark, table, ids[-taken:])
        if found is not None and (taken >= len(ids) or found.count() >= rows):
            return found
    return None
