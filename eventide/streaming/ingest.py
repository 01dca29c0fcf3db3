"""One read of the event topic: raw messages parsed once into an append table.

Everything downstream reads that table as a stream. It is written by Spark's own
file sink, whose log names the files of committed batches, so a replay after a
failure neither loses nor repeats a row. Messages that are no valid event lie
in the same table, from the same pass, in a partition of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventide.config import WATERMARK_DELAY
from eventide.schemas import USER_EVENT
from eventide.sources.events_json import CORRUPT_COLUMN, parse_events
from eventide.streaming.tables import Layout, checkpoint_of, prepare_streaming, started, table_stream

#: Columns of the source that stay beside the event, null where a source has none.
ARRIVAL = T.StructType([
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])
#: ``value`` is the message as it came where it is no valid event, else null.
INGESTED = T.StructType([T.StructField(f.name, f.dataType) for f in USER_EVENT.fields] + ARRIVAL.fields
                        + [T.StructField("value", T.StringType()), T.StructField("malformed", T.BooleanType())])


def ingested(raw: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Raw messages -> rows of the event table.

    FAILFAST fails the query on malformed JSON (the reference's behaviour),
    PERMISSIVE keeps such messages apart. The time of an event whose own cannot
    be read is that of the batch, the same for all readers of the table.
    """
    keep = [f.name for f in ARRIVAL.fields if f.name in raw.columns]
    parsed = parse_events(raw, mode=mode, keep=keep)
    bad = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in parsed.columns else F.lit(None).cast("string")
    events = [F.col(f.name) for f in USER_EVENT.fields]
    arrival = [(F.col(f.name) if f.name in keep else F.lit(None)).cast(f.dataType).alias(f.name) for f in ARRIVAL.fields]
    return parsed.select(*events, *arrival, bad.alias("value"), bad.isNotNull().alias("malformed"))


def start_ingest(raw: DataFrame, layout: Layout, mode: str = "FAILFAST", checkpoint: str | None = None,
                 trigger: dict | None = None, name: str = "ingest") -> StreamingQuery:
    """The only query that reads the raw stream."""
    spark = raw.sparkSession
    prepare_streaming(spark)
    writer = (ingested(raw, mode).writeStream.format("parquet").outputMode("append").partitionBy("malformed")
              .option("path", layout.events).queryName(name)
              .option("checkpointLocation", checkpoint_of(spark, name, checkpoint, layout)))
    return started(writer, trigger)


def event_table(spark: SparkSession, layout: Layout, watermark: bool = True, files_per_batch: int | None = None) -> DataFrame:
    """The well-formed events as a stream, with the 30 s bounded out-of-orderness unless asked otherwise."""
    rows = table_stream(spark, layout.events, INGESTED, files_per_batch, partitioned=True)
    events = rows.filter(~F.col("malformed")).drop("malformed", "value")
    return events.withWatermark("event_time", WATERMARK_DELAY) if watermark else events


def quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """The messages that are no valid event, with their arrival columns."""
    rows = spark.read.schema(INGESTED).parquet(layout.events)
    return rows.filter("malformed").select("value", *[f.name for f in ARRIVAL.fields])
