"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment covers a run of documents and holds
their dictionary (sorted terms), each term's number of postings, and its
postings: word positions, counted through the segment with one free place after
each document, so that no phrase crosses documents. A segment is built inside
one task from what the task reads; nothing is shuffled, and a word that fills
the corpus is one list per segment.

A search holds phrases against every segment. For a phrase it takes the lists of
its terms from the rarest on, moves each by the term's offset in the phrase, and
intersects them. With ``slop`` a term may stand that many words off its place.
The phrases are made and told apart on Spark and written as a table in blocks
of bounded size. Block by block they are sent to the tasks and the matches added to
a table, so neither the plan nor the driver grows with the test set; the segments are
read once for each block.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import free_name, saved, scratch, table

#: Consecutive words of an item that make a match.
WINDOW = 10
#: Words by which a term may be off its place in a proximity match.
SLOP = 2
#: Words of a segment; a longer document is a segment of its own.
SEGMENT_WORDS = 500_000
#: Windows of the test items that are searched for in one pass, about.
BLOCK_WINDOWS = 200_000

#: A-Z to a-z, other ASCII characters that are no digit or letter to blanks: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c
             for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a whole text; null has none."""
    return (text or "").encode().translate(FOLD).split()


# --- the index -----------------------------------------------------------------------------

def pack(words: list[bytes], places: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Terms (sorted, one a line), posting counts and postings of a segment."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    terms = coded.dictionary
    order = pc.sort_indices(terms).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    codes = rank[coded.indices.to_numpy()] if len(order) else np.zeros(0, np.int32)
    postings = places[np.argsort(codes, kind="stable")]
    counts = np.bincount(codes, minlength=len(order))
    return (b"\n".join(terms.take(pa.array(order)).to_pylist()), counts.astype("<u4").tobytes(),
            postings.astype("<u4").tobytes())


def build_index(docs: DataFrame, keys: list[str], text: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of ``docs`` as a table in the shared folder, one row per segment.

    ``docs`` of a row lists its documents in order as (key columns, n_words).
    Null texts are documents without words; repeated rows are documents of their own.
    """
    kinds = [docs.schema[k] for k in keys]
    entry = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(kinds)]
                         + [T.StructField("n_words", T.LongType())])
    schema = T.StructType([T.StructField("segment", T.LongType()), T.StructField("docs", T.ArrayType(entry)),
                           *(T.StructField(c, T.BinaryType()) for c in ("terms", "counts", "postings"))])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        words, places, listed, place = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal words, places, listed, place, made
            row = [base + made, listed, *pack(words, np.concatenate(places) if places else np.zeros(0, np.int64))]
            made += 1
            words, places, listed, place = [], [], [], 0
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema=arrow)

        arrow = None
        for batch in batches:
            if arrow is None:
                entry_type = pa.struct([*(pa.field(f"k{i}", batch.schema.field(i).type) for i in range(len(keys))),
                                        pa.field("n_words", pa.int64())])
                arrow = pa.schema([("segment", pa.int64()), ("docs", pa.list_(entry_type)), ("terms", pa.binary()),
                                   ("counts", pa.binary()), ("postings", pa.binary())])
            for row, doc in enumerate(batch.column(len(keys))):
                own = words_of(doc.as_py())
                if words and len(words) + len(own) > segment_words:
                    yield close()
                listed.append({f"k{i}": batch.column(i)[row].as_py() for i in range(len(keys))} | {"n_words": len(own)})
                words += own
                places.append(np.arange(place, place + len(own)))
                place += len(own) + 1
        if listed:
            yield close()

    return saved(docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`")).mapInArrow(segments, schema), "index")


# --- the search ----------------------------------------------------------------------------

class Segment:
    """One row of the index, opened for a search."""

    def __init__(self, lengths: list[int], terms: bytes, counts: bytes, postings: bytes):
        self.terms = terms.split(b"\n") if terms else []
        self.ends = np.concatenate([[0], np.cumsum(np.frombuffer(counts, "<u4"), dtype=np.int64)])
        self.postings = np.frombuffer(postings, "<u4")
        self.starts = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64) + 1)])[:-1]
        self.lengths = np.asarray(lengths, np.int64)

    def lists(self, terms: Iterable[bytes]) -> dict[bytes, np.ndarray]:
        """Postings of those of ``terms`` that the segment has."""
        found = {}
        for term in terms:
            k = bisect_left(self.terms, term)
            if k < len(self.terms) and self.terms[k] == term:
                found[term] = self.postings[self.ends[k]:self.ends[k + 1]].astype(np.int64)
        return found

    def match(self, phrase: tuple[bytes, ...], lists: dict[bytes, np.ndarray], slop: int = 0,
              among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places where the phrase starts (``among`` given ones), and their documents.

        It starts at a place if each of its terms stands within ``slop`` words of the place plus the
        term's offset, in one document. With a slop a place can come more than once, and can lie
        up to ``slop`` words outside the document.
        """
        if any(t not in lists for t in phrase):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = sorted(range(len(phrase)), key=lambda k: len(lists[phrase[k]]))
        rarest = lists[phrase[order[0]]]
        doc = np.searchsorted(self.starts, rarest, "right") - 1
        starts = (rarest[:, None] - order[0] + np.arange(-slop, slop + 1)).ravel()
        doc = np.repeat(doc, 2 * slop + 1)
        if among is not None:
            kept = np.isin(starts, among)
            starts, doc = starts[kept], doc[kept]
        for k in order[1:]:
            if not len(starts):
                break
            posted, at = lists[phrase[k]], starts + k
            low = np.maximum(at - slop, self.starts[doc])
            high = np.minimum(at + slop, self.starts[doc] + self.lengths[doc] - 1)
            nearest = posted[np.minimum(np.searchsorted(posted, low), len(posted) - 1)]
            kept = (nearest >= low) & (nearest <= high)
            starts, doc = starts[kept], doc[kept]
        return starts, doc


def windows(benchmark: DataFrame, item: str, text: str, size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items (words joined by blanks) and the items that have them: window, items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, doc in zip(batch.column(0), batch.column(1), strict=True):
                own = words_of(doc.as_py())
                for low in range(0, max(1, len(own) - size + 1) if own else 0, 10_000):
                    found = {b" ".join(own[k:k + size]) for k in range(low, min(low + 10_000, max(1, len(own) - size + 1)))}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found), pa.binary()), pa.array([name.as_py()] * len(found), pa.string())], ["window", "item"])

    named = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")), F.col(f"`{text}`"))
    return named.mapInArrow(cut, "window binary, item string").groupBy("window").agg(F.collect_set("item").alias("items"))


MATCHES = "segment long, at int, items array<string>, near_items array<string>, spans array<struct<s:long,e:long>>"


def search(index: DataFrame, shared: Broadcast, slop: int = SLOP) -> DataFrame:
    """Matches by document: (segment, its place ``at`` in it, exact items, proximity items, exact word spans).

    Only documents with a match of either kind have a row. An exact match is
    also a proximity match. ``shared`` holds one block of the test set: phrase
    (tuple of words) -> items.
    """
    names = ["segment", "at", "items", "near_items", "spans"]
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()),
             pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        vocabulary = sorted({t for phrase in wanted for t in phrase})
        for batch in batches:
            for k in range(batch.num_rows):
                row, = batch.slice(k, 1).to_pylist()
                seg = Segment(row["lengths"], row["terms"], row["counts"], row["postings"])
                lists = seg.lists(vocabulary)
                hits = defaultdict(lambda: (set(), set(), set()))
                for phrase, items in wanted.items():
                    near, inside = seg.match(phrase, lists, slop)
                    if not len(near):
                        continue
                    for d in set(inside.tolist()):
                        hits[d][1].update(items)
                    exact, inside = seg.match(phrase, lists, 0, near)
                    for p, d in zip((exact - seg.starts[inside]).tolist(), inside.tolist(), strict=True):
                        hits[d][0].update(items)
                        hits[d][2].add((p, p + len(phrase)))
                if hits:
                    found = [(row["segment"], d, sorted(h[0]), sorted(h[1]), [{"s": s, "e": e} for s, e in sorted(h[2])])
                             for d, h in sorted(hits.items())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f[k] for f in found], kinds[k]) for k in range(len(names))], names)

    return index.select("segment", F.col("docs.n_words").alias("lengths"), "terms", "counts",
                        "postings").mapInArrow(find, MATCHES)


def search_all(index: DataFrame, phrases: DataFrame, slop: int, block_windows: int) -> DataFrame:
    """:func:`search` for all phrases (window, items), block by block; the matches as a table."""
    spark = index.sparkSession
    known = saved(phrases, "windows")
    blocks = math.ceil(known.count() / block_windows)
    numbered, found = scratch(spark, "blocks"), scratch(spark, "matches")
    known.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(max(blocks, 1)))).repartition("block").write.partitionBy(
        "block").parquet(numbered)
    for block in range(blocks):
        part = spark.read.schema("window binary, items array<string>, block long").parquet(numbered).where(
            F.col("block") == block).select("window", "items").toArrow()
        shared = spark.sparkContext.broadcast({tuple(w.split(b" ")): items for w, items in zip(
            part.column("window").to_pylist(), part.column("items").to_pylist(), strict=True)})
        search(index, shared, slop).write.mode("append").parquet(found)
        shared.destroy()
    return spark.read.schema(MATCHES).parquet(found) if blocks else spark.createDataFrame([], MATCHES)


def decontaminate(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, slop: int = SLOP,
                  block_windows: int = BLOCK_WINDOWS, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row per document: its key columns, ``n_words``, ``n_hit``, ``items``, ``near_items``, ``spans``.

    A window is ``window`` consecutive words of an item, or the whole of a
    shorter one; an item without words (null, empty) has none. ``spans`` are the
    word ranges of exact occurrences, ``n_hit`` counts the words in any of them.
    ``items`` and ``near_items`` are sorted item ids as strings (a null id is the
    empty string). Repeated documents keep their own rows; an empty benchmark
    matches nothing; an empty table gives no rows.
    """
    index = build_index(docs, keys, text, segment_words)
    found = search_all(index, windows(benchmark, item, item_text, window), slop, block_windows)
    together = found.groupBy("segment", "at").agg(
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items", "spans")])
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a.upto, x.e).alias("upto"),
                              (a.n + F.greatest(F.lit(0).cast("long"), x.e - F.greatest(a.upto, x.s))).alias("n")),
        lambda a: a.n)
    listed = index.select("segment", F.posexplode("docs").alias("at", "doc"))
    none = F.array().cast("array<string>")
    return listed.join(together, ["segment", "at"], "left").select(
        *[F.col(f"doc.k{i}").alias(k) for i, k in enumerate(keys)], F.col("doc.n_words").alias("n_words"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"), "spans")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents in which a window of the benchmark occurs; columns as they are.

    A row is judged by its own text: rows that share a key but not the text are told apart.
    """
    print_, other = free_name(docs, "fingerprint", "key")
    marked = docs.withColumn(print_, F.xxhash64(F.col(f"`{text}`")))
    # a table, so that its size is known: it is broadcast where that is small, and no text is shuffled
    hit = saved(decontaminate(marked, benchmark, [key, print_], text).where("n_hit > 0").select(
        F.col(f"`{key}`").alias(other), F.col(print_).alias(print_ + "2")).distinct(), "hit")
    same = marked[key].eqNullSafe(hit[other]) & (marked[print_] == hit[print_ + "2"])
    return marked.join(hit, same, "left_anti").drop(print_)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in benchmark windows, with the items they belong to."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"))
