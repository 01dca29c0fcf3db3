"""The latest value of every feature as the state of a streaming aggregation.

The compacted store of the reference is the state of one query: the newest
record per (entity, feature), kept by Spark's state store under the query's
checkpoint. Every committed batch is a version. Lookups and dumps read a
version with the state data source, from any session that sees the checkpoint,
also while the query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.store import latest_features
from eventide.streaming.tables import Layout, checkpoint_of, prepare_streaming, started

NAME = "latest_features"


def start_latest(log: DataFrame, checkpoint: str, trigger: dict | None = None, name: str = NAME) -> StreamingQuery:
    """Keep the latest record per (entity, feature) of a streaming feature log. A batch that
    changes k of them writes k; records that come again change nothing."""
    prepare_streaming(log.sparkSession)
    writer = (latest_features(log).writeStream.format("noop").outputMode("update").queryName(name)
              .option("checkpointLocation", checkpoint))
    return started(writer, trigger)


def latest_checkpoint(spark: SparkSession, layout: Layout) -> str:
    """Where the job's own latest values are."""
    return checkpoint_of(spark, NAME, None, layout)


def read_latest(spark: SparkSession, checkpoint: str, entity_id: str | None = None, version: int | None = None) -> DataFrame:
    """Latest records of a committed version (the newest), of one entity or all.

    A checkpoint without a committed version raises an error.
    """
    reader = spark.read.format("statestore")
    if version is not None:
        reader = reader.option("batchId", str(version))
    state = reader.load(checkpoint)
    value = F.col("value").getField(state.schema["value"].dataType.fieldNames()[0])  # max_by keeps (value, its order)
    rows = state.select("key.entity_id", "key.feature_name", *[
        value.getField(c).alias(c) for c in ("feature_value", "computed_at", "received_at", "seq")])
    return rows if entity_id is None else rows.filter(F.col("entity_id") == F.trim(F.lit(entity_id)))
