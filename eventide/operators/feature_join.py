"""Full outer join of two streams of features on a state of packed rows.

A stream–stream join keeps several state entries for each row of both sides, which
costs more than all else where every window of every user is one row. Here the rows
of an hour of window ends and a share of the entities are one value of the state, an
Arrow batch, and rows pass to Python in such packs. What comes out is what a
stream–stream join gives: a row meets those of the other side that came before or
with it, each pair once, and one that met none comes out when the watermark passes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keys that the entities of one hour are dealt to. Fixed for a checkpoint.
SHARES = 16
#: Rows of a partition that are packed at once.
PACKED_ROWS = 500_000
HOUR = 3_600_000_000
#: The end of rows that have none.
NEVER = 2**63 - 1
#: Packed rows; ``end`` in microseconds, ``matched`` if a row of the other side was met.
PACK = pa.schema([("of_left", pa.bool_()), ("id", pa.string()), ("name", pa.string()), ("end", pa.int64()), ("value", pa.float64()),
                  ("matched", pa.bool_())])
PACKS = "slot bigint, share int, pack binary"
#: What the state gives: a list for each column.
MET = "id array<string>, name array<string>, end array<bigint>, l array<double>, r array<double>"


def join_features(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows ``(id, name, end, l, r)`` whose values differ, and rows that met no other.

    Both sides are ``(id, name, end, value)`` with a watermark on ``end``. As in a stream–stream
    join null keys meet null keys, and the watermark never passes a row without an end."""
    def side(rows: DataFrame, of_left: bool) -> DataFrame:
        end = F.coalesce(F.unix_micros("end"), F.lit(NEVER))
        return rows.select(
            F.floor((end - F.pmod(end, F.lit(HOUR))) / F.lit(HOUR)).cast("bigint").alias("slot"),
            F.pmod(F.xxhash64("id"), F.lit(SHARES)).cast("int").alias("share"),
            F.lit(of_left).alias("of_left"), "id", "name", end.alias("end"), F.col("value").cast("double").alias("value"))

    packs = side(left, True).unionByName(side(right, False)).mapInArrow(_packs, PACKS)
    met = packs.groupBy("slot", "share").transformWithState(FeatureJoin(), MET, "append", "eventTime")
    return met.select(F.inline(F.arrays_zip("id", "name", "end", "l", "r"))).withColumn(
        "end", F.timestamp_micros(F.nullif("end", F.lit(NEVER))))


class FeatureJoin(StatefulProcessor):
    """State of one hour of window ends and one share of the entities."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getValueState("rows", "pack binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark API
        came = pa.Table.from_batches([_unpacked(r.pack) for r in rows], PACK)
        came = came.filter(pc.greater(came["end"], timerValues.getCurrentWatermarkInMs() * 1000))
        if not len(came):
            return
        stored = self._stored()
        known = pa.concat_tables([stored, came]).combine_chunks()
        left, right = _pairs(known, len(stored))
        matched = known["matched"].to_numpy().copy()
        matched[left] = matched[right] = True
        self._store(known.set_column(PACK.get_field_index("matched"), "matched", pa.array(matched)))
        if not len(stored) or pc.min(came["end"]).as_py() < pc.min(stored["end"]).as_py():
            self._wake(came)
        differ = _differ(known["value"].take(left), known["value"].take(right))
        if differ.any():
            left, right = left[differ], right[differ]
            yield _row(known.take(left), known["value"].take(left), known["value"].take(right))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803 - Spark API
        stored = self._stored()
        past = pc.less_equal(stored["end"], timerValues.getCurrentWatermarkInMs() * 1000)
        gone, kept = stored.filter(past), stored.filter(pc.invert(past))
        if len(gone):
            self._store(kept)
        if len(kept):
            self._wake(kept)
        alone = gone.filter(pc.invert(gone["matched"]))
        if len(alone):
            none = pa.scalar(None, pa.float64())
            yield _row(alone, pc.if_else(alone["of_left"], alone["value"], none), pc.if_else(alone["of_left"], none, alone["value"]))

    def _stored(self) -> pa.Table:
        found = self.rows.get()
        return pa.Table.from_batches([_unpacked(found[0])] if found else [], PACK)

    def _store(self, rows: pa.Table) -> None:
        if len(rows):
            self.rows.update((_packed(rows.combine_chunks().to_batches()[0]),))
        else:
            self.rows.clear()

    def _wake(self, rows: pa.Table) -> None:
        """A timer fires when the watermark, in milliseconds, is greater: here, when it is at the first end or past it."""
        first = pc.min(rows["end"]).as_py()
        if first != NEVER:
            self.handle.registerTimer(-(-first // 1000) - 1)

    def close(self) -> None:
        pass


def _packed(rows: pa.RecordBatch) -> bytes:
    return rows.serialize().to_pybytes()


def _unpacked(pack: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(pack), PACK)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each slot and share, packed."""
    for rows in _gathered(batches):
        rows = rows.sort_by([("slot", "ascending"), ("share", "ascending")]).combine_chunks()
        slot, share = rows["slot"].to_numpy(), rows["share"].to_numpy()
        first = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (share[1:] != share[:-1])])
        whole = rows.append_column("matched", pa.array(np.zeros(len(rows), bool))).select(PACK.names).cast(PACK).to_batches()[0]
        packs = [_packed(whole.slice(a, b - a)) for a, b in zip(first, [*first[1:], len(rows)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(slot[first]), pa.array(share[first]), pa.array(packs, pa.binary())], ["slot", "share", "pack"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACKED_ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _pairs(known: pa.Table, n_stored: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of left and right rows of equal keys, at least one of them behind the first ``n_stored``."""
    none = [pc.is_null(known[c]).combine_chunks().cast(pa.int8()) for c in ("id", "name")]
    rows = pa.table({"id": pc.fill_null(known["id"], ""), "name": pc.fill_null(known["name"], ""), "end": known["end"],
                     "none_id": none[0], "none_name": none[1], "at": pa.array(np.arange(len(known)))})
    of_left = known["of_left"]
    pairs = rows.filter(of_left).join(rows.filter(pc.invert(of_left)), rows.column_names[:-1], join_type="inner", right_suffix="_r",
                                      use_threads=False)
    left, right = pairs["at"].to_numpy(), pairs["at_r"].to_numpy()
    new = (left >= n_stored) | (right >= n_stored)
    return left[new], right[new]


def _differ(left: pa.ChunkedArray, right: pa.ChunkedArray) -> np.ndarray:
    """Whether values differ as Spark has it: null is the same as null, and NaN as NaN."""
    a, b = left.to_numpy(), right.to_numpy()
    no_a, no_b = left.is_null().to_numpy(), right.is_null().to_numpy()
    return (no_a != no_b) | ~(no_a | (a == b) | (np.isnan(a) & np.isnan(b)))


def _row(rows: pa.Table, left: pa.ChunkedArray, right: pa.ChunkedArray) -> Row:
    return Row(**{c: rows[c].to_pylist() for c in ("id", "name", "end")}, l=left.to_pylist(), r=right.to_pylist())
