"""Category affinity on streams: keyed state in Spark's state store, two queries.

The first joins events with the metadata changelog. Its state is keyed by
(content, share of the users): the content's category, and for each of the
share's users how often they used the content. Events come in as pair counts,
counted within a few Arrow batches; of the changelog rows there a content's
newest goes to all its shares. What goes out are differences ``(user, category,
n)``: new counts under the content's category, and, when that changes, the
earlier counts taken from the old category and added to the new one. So a batch
costs what it changes, and a hot content is spread over ``SHARES`` keys.

Python gets and gives rows one by one, and every access to state is a message to
the JVM and back. So the counts of many users, as a JSON object by user, are one
row on the way in and out, and one value of the state: a key has buckets of about
``BUCKET_USERS`` users, which are split as users come.

The second query sums the differences per (user, category) in the state of a
streaming aggregation and writes every total that changed as an affinity record.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from eventide.functions.timefmt import iso_seconds
from eventide.operators import affinity as aff
from eventide.streaming.sinks import write_batch
from eventide.streaming.tables import Layout, checkpoint_of, log_rows, prepare_streaming, started, table_stream

#: Keys that the users of one content are dealt to. Fixed for a checkpoint.
SHARES = 16
#: Users that share a value of the state.
BUCKET_USERS = 1024
#: Rows of a partition that are counted at once.
COUNTED_ROWS = 100_000
MOVES = "user_id string, category string, n bigint"
#: Rows of the joined stream: pair counts (a JSON object by user) or a changelog row (no counts).
EITHER = "content_id string, share int, counts string, category string, seq bigint, deleted boolean"
#: What the state gives: differences of one category (a JSON object by user).
MOVED = "category string, counts string"


class CategoryMoves(StatefulProcessor):
    """State of one content and one share of its users."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.content = handle.getValueState("content", "category string, seq bigint, n_users bigint, n_buckets int")
        #: A bucket's counts as a JSON object, by user.
        self.users = handle.getMapState("users", "bucket int", "counts string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark API
        counts: Counter = Counter()
        newest = None
        for r in rows:
            if r.counts is not None:
                counts.update(json.loads(r.counts))
            elif newest is None or r.seq > newest.seq:
                newest = r
        before = tuple(self.content.get() or (None, None, 0, 1))
        old, seq, n_users, n_buckets = before
        now = old
        if newest is not None and (seq is None or newest.seq > seq):
            now, seq = None if newest.deleted else newest.category, newest.seq
        if now != old:
            for _, (stored,) in self.users.iterator():
                if old is not None:
                    yield Row(category=old, counts=json.dumps({user: -n for user, n in json.loads(stored).items()}))
                if now is not None:
                    yield Row(category=now, counts=stored)
        if counts:
            n_buckets = self._split(n_buckets, n_users + len(counts))
            for bucket, found in _dealt(counts, n_buckets).items():
                n_users += self._add(bucket, found)
                if now is not None:
                    yield Row(category=now, counts=json.dumps(found))
        if (now, seq, n_users, n_buckets) != before:
            self.content.update((now, seq, n_users, n_buckets))

    def _split(self, n_buckets: int, n_users: int) -> int:
        """Deal the stored counts to enough buckets for so many users; how many there are then."""
        more = n_buckets
        while more * BUCKET_USERS < n_users:
            more *= 2
        for bucket in range(n_buckets if more > n_buckets else 0):
            stored = self.users.getValue((bucket,))
            if stored:
                for part, counts in _dealt(json.loads(stored[0]), more).items():
                    self.users.updateValue((part,), (json.dumps(counts),))
                    stored = stored if part != bucket else None
                if stored:  # all its users went to others
                    self.users.removeKey((bucket,))
        return more

    def _add(self, bucket: int, counts: dict[str, int]) -> int:
        """Add counts to those stored in their bucket; how many users are new."""
        stored = self.users.getValue((bucket,))
        known = json.loads(stored[0]) if stored else {}
        before = len(known)
        for user, n in counts.items():
            known[user] = known.get(user, 0) + n
        self.users.updateValue((bucket,), (json.dumps(known),))
        return len(known) - before

    def close(self) -> None:
        pass


def _dealt(counts: dict[str, int], n_buckets: int) -> dict[int, dict[str, int]]:
    """Counts by bucket. With twice as many buckets, each one's users go to itself and to one new bucket."""
    dealt: dict[int, dict[str, int]] = defaultdict(dict)
    for user, n in counts.items():
        dealt[zlib.crc32(user.encode()) % n_buckets][user] = n
    return dealt


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= COUNTED_ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each content and share the counts by user."""
    for rows in _gathered(batches):
        found = rows.group_by(["content_id", "share", "user_id"]).aggregate([([], "count_all")])
        counts: dict[tuple[str, int], dict[str, int]] = defaultdict(dict)
        for content, share, user, n in zip(*(found[c].to_pylist() for c in ("content_id", "share", "user_id", "count_all")), strict=True):
            counts[content, share][user] = n
        yield pa.RecordBatch.from_arrays([
            pa.array([content for content, _ in counts], pa.string()), pa.array([share for _, share in counts], pa.int32()),
            pa.array([json.dumps(c) for c in counts.values()], pa.string())], ["content_id", "share", "counts"])


def _newest_changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each content the row with the greatest ``seq``, the first of equal ones."""
    for rows in _gathered(batches):
        rows = rows.append_column("at", pa.array(range(len(rows)), pa.int64()))
        rows = rows.take(pc.sort_indices(rows, [("seq", "descending"), ("at", "ascending")])).drop_columns("at")
        rows = rows.append_column("at", pa.array(range(len(rows)), pa.int64()))
        first = rows.group_by("content_id").aggregate([("at", "min")])["at_min"]
        yield from rows.take(first).drop_columns("at").to_batches()


def either(events: DataFrame, changes: DataFrame, shares: int = SHARES) -> DataFrame:
    """Pair counts of the events and the changelog, keyed for the state. Rows without a key are skipped."""
    share = F.pmod(F.xxhash64("user_id"), F.lit(shares)).cast("int")
    pairs = events.filter(F.col("user_id").isNotNull() & F.col("content_id").isNotNull()).select(
        "content_id", share.alias("share"), "user_id").mapInArrow(_pair_counts, "content_id string, share int, counts string")
    none = lambda kind: F.lit(None).cast(kind)
    counted = pairs.select("content_id", "share", "counts", none("string").alias("category"), none("bigint").alias("seq"),
                           none("boolean").alias("deleted"))
    newest = changes.filter(F.col("content_id").isNotNull()).select("content_id", "category", "seq", "deleted").mapInArrow(
        _newest_changes, "content_id string, category string, seq bigint, deleted boolean")
    every = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")
    changed = newest.select("content_id", every, none("string").alias("counts"), "category", "seq", "deleted")
    return counted.unionByName(changed)


def start_moves(events: DataFrame, changes: DataFrame, layout: Layout, checkpoint: str | None = None,
                trigger: dict | None = None, name: str = "category_moves", shares: int = SHARES) -> StreamingQuery:
    """``events`` without a watermark: affinity is a lifetime count. ``changes`` is the changelog as a stream.

    Both have their offsets in this query's checkpoint: a changelog row is read
    once. A content's rows are compared by ``seq``, which orders them within
    the partition of their key.
    """
    spark = events.sparkSession
    prepare_streaming(spark)
    moved = either(events, changes, shares).groupBy("content_id", "share").transformWithState(
        CategoryMoves(), MOVED, "append", "none")
    moves = moved.select("category", F.explode(F.from_json("counts", "map<string, bigint>")).alias("user_id", "n")).select(
        "user_id", "category", "n")
    writer = (moves.writeStream.format("parquet").outputMode("append").option("path", layout.moves).queryName(name)
              .option("checkpointLocation", checkpoint_of(spark, name, checkpoint, layout)))
    return started(writer, trigger)


def start_affinity(spark: SparkSession, layout: Layout, checkpoint: str | None = None, trigger: dict | None = None,
                   emit_zero: bool = False, sink: Callable[[DataFrame], None] | None = None,
                   name: str = "category_affinity") -> StreamingQuery:
    """Differences -> totals -> affinity records, once per changed (user, category) and batch.

    A total that fell to zero is a retraction: dropped unless ``emit_zero``.
    """
    prepare_streaming(spark)
    totals = table_stream(spark, layout.moves, MOVES).groupBy("user_id", "category").agg(F.sum("n").alias("n"))

    def write(df: DataFrame, batch_id: int) -> None:
        changed = df.filter(F.col("n") >= 0 if emit_zero else F.col("n") > 0)
        rows = log_rows(aff.affinity_features_from_counts(changed, iso_seconds(F.current_timestamp())), batch_id)
        write_batch(rows, layout.affinity, batch_id)
        if sink is not None:  # the rows as written, not a second evaluation with other times
            sink(df.sparkSession.read.schema(rows.schema).parquet(f"{layout.affinity}/batch_id={batch_id}"))

    writer = (totals.writeStream.outputMode("update").foreachBatch(write).queryName(name)
              .option("checkpointLocation", checkpoint_of(spark, name, checkpoint, layout)))
    return started(writer, trigger)
