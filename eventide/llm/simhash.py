"""SimHash near-dedup with BK-trees.

Documents become 64-bit fingerprints; equal fingerprints are one node from then
on, so copies cost nothing. Fingerprints within the radius must agree on whole
blocks of bits, hence they meet in a shard of all fingerprints that agree on a
choice of blocks. A task builds a BK-tree per shard, children keyed by their
integer Hamming distance to the parent, and looks every member up in it,
following only edges within the radius of the distance just measured.

The trees are not broadcast: all of them together are all fingerprints, which
have no size bound. They go to the lookups by one shuffle instead. A shard has
at most about ``TREE_SIZE`` members; larger ones are cut into parts, and every
pair of parts is a task's tree and its lookups. A shard's links leave the task
as a spanning forest, never as all pairs. Components of the forests come from
alternating star contractions over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import dropped, free_name, saved, table

#: Words of a shingle; differing bits up to which fingerprints are linked.
SHINGLE, RADIUS = 4, 4
#: Fingerprints in a tree, about.
TREE_SIZE = 2_048
#: Shingles that are hashed and counted at once.
CHUNK = 16_384


# --- fingerprints --------------------------------------------------------------------------

def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of a whole text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:min(n, at + CHUNK) + size - 1]
        data = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        width = min(size, len(part))
        hashes = [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts.tolist(), ends[width - 1:].tolist(), strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), size) for t in texts], np.uint64).view(np.int64))

    return simhash


# --- BK-trees ------------------------------------------------------------------------------

def bk_tree(values: np.ndarray) -> np.ndarray:
    """BK-tree of distinct fingerprints: ``child[node, distance]``, -1 for none; node 0 is the root.

    All values descend together: those that come to a node at the same distance
    share an edge; the first of them becomes the child, the others go on there.
    """
    child = np.full((len(values), 65), -1, np.int32)
    rows = np.arange(1, len(values))
    at = np.zeros(len(rows), np.int64)
    while len(rows):
        edge = at * 65 + np.bitwise_count(values[rows] ^ values[at])
        edges, first, which = np.unique(edge, return_index=True, return_inverse=True)
        child.ravel()[edges] = rows[first]
        at = rows[first][which]
        stay = np.ones(len(rows), bool)
        stay[first] = False
        rows, at = rows[stay], at[stay]
    return child


def lookups(values: np.ndarray, child: np.ndarray, queries: np.ndarray, radius: int,
            batch: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) at most ``radius`` bits apart, for a batch of queries at a time."""
    reach = np.arange(-radius, radius + 1)
    for low in range(0, len(queries), batch):
        q = np.arange(low, min(low + batch, len(queries)))
        node = np.zeros(len(q), np.int64)
        found = []
        while len(q):
            d = np.bitwise_count(queries[q] ^ values[node]).astype(np.int64)
            near = d <= radius
            found.append((q[near], node[near]))
            edge = d[:, None] + reach
            below = np.where((edge >= 0) & (edge <= 64), child[node[:, None], np.clip(edge, 0, 64)], -1)
            at, k = np.nonzero(below >= 0)
            q, node = q[at], below[at, k].astype(np.int64)
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each a and b; ``roots`` points from every member to its set's smallest."""
    while len(a):
        x, y = roots[a], roots[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := roots[roots], roots):
            roots[:] = up


def forest(members: np.ndarray, others: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smaller fingerprint) that connect what the radius connects.

    Within ``members``, or between them and ``others`` where given.
    """
    members = np.unique(members)
    queries = members if others is None else np.unique(others)
    both = members if others is None else np.concatenate([members, queries])
    if len(both) < 2 or not len(members):
        return both[:0], both[:0]
    values, shift = members.view(np.uint64), 0 if others is None else len(members)
    roots = np.arange(len(both))
    for q, node in lookups(values, bk_tree(values), queries.view(np.uint64), radius):
        merge(roots, q + shift, node)
    linked = np.flatnonzero(roots != np.arange(len(both)))
    return both[linked], both[roots[linked]]


# --- shards --------------------------------------------------------------------------------

def block_choice(n: int, radius: int = RADIUS) -> int:
    """Number of blocks for ``n`` fingerprints: the least work. Any number above the radius finds all links."""

    def work(blocks: int) -> float:
        bits = (blocks - radius) * (64 // blocks)
        return comb(blocks, radius) * (40 + n / 2 ** bits)

    return min(range(radius + 1, radius + 5), key=work)


def shard_keys(fp, blocks: int, radius: int):
    """The shards of a fingerprint: for each choice of ``blocks - radius`` blocks, its bits there."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [sum(1 << bit for k in chosen for bit in range(edges[k], edges[k + 1]))
             for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(signed)])


def links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int | None = None, tree_size: int = TREE_SIZE) -> DataFrame:
    """Spanning links (``a``, ``b``; a > b) of distinct fingerprints (``fp`` long) over all shards."""
    blocks = blocks or block_choice(fingerprints.count(), radius)
    rows = fingerprints.select("fp", F.explode(shard_keys(F.col("fp"), blocks, radius)).alias("s")).select("fp", "s.*")
    large = rows.groupBy("choice", "bits").count().where(F.col("count") > tree_size).select(
        "choice", "bits", F.ceil(F.col("count") / tree_size).cast("int").alias("parts"))
    cut = rows.join(large, ["choice", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # a part meets every part of its shard once: the one with the smaller number is the tree
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "choice", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("tree"), "fp")
    group = ["choice", "bits", "i", "j"]

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at = None

        def done() -> list[tuple[np.ndarray, np.ndarray]]:
            if not held:
                return []
            fp, tree = (np.concatenate(x) for x in zip(*held, strict=True))
            if at[2] == at[3]:
                return [forest(fp, None, radius)] if len(fp) > 1 else []
            return [forest(fp[tree], fp[~tree], radius)]

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
            tree, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in (4, 5))
            starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(fp)]])
            out = []
            for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if low == high:
                    continue
                if (key := tuple(keys[:, low].tolist())) != at:
                    out += done()
                    held, at = [], key
                held.append((fp[low:high], tree[low:high]))
            if out:
                a, b = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])
        for a, b in done():
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return met.repartition(*group).sortWithinPartitions(*group).mapInArrow(trees, "a long, b long").distinct()


# --- components ----------------------------------------------------------------------------

def _star(edges: DataFrame) -> DataFrame:
    """Each end ``u`` of directed edges (u, v) with the smallest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b; a > b) with the smallest node it reaches.

    Large and small stars in turn, as published by Kiveris et al. (2014): each
    round links a node's neighbours to the smallest of them, until every node
    hangs on its root. Minima are aggregated before the shuffle and joined back,
    so that no node's neighbours gather in one task.
    """
    now = saved(edges, "edges")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(state):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark, before = tuple(state), now
        each = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = each.join(_star(each), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        step = saved(large, "large")
        small = step.join(_star(step), "u")
        now = saved(small.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            small.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        dropped(step)
        dropped(before)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, blocks: int | None = None, tree_size: int = TREE_SIZE) -> DataFrame:
    """One row per document: ``key``, ``fp`` (long), ``component`` (smallest key it reaches, itself included).

    Texts without words (null, empty, blank) have the fingerprint zero and are
    linked like any other. Repeated rows keep their rows; a null key is never
    the smallest unless all of a component are null. An empty table gives no rows.
    """
    return _placed(docs, key, text, shingle, radius, blocks, tree_size).select(F.col("key").alias(key), "fp", "component")


def _placed(docs: DataFrame, key: str, text: str, shingle: int, radius: int, blocks: int | None = None,
            tree_size: int = TREE_SIZE) -> DataFrame:
    """One row per document: key, ``mark`` (a hash of its text), fp, component."""
    rows = saved(docs.select(F.col(f"`{key}`").alias("key"), _mark(text).alias("mark"),
                             _fingerprints(shingle)(F.col(f"`{text}`")).alias("fp")), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("key").alias("first")), "nodes")
    rooted = components(links(nodes.select("fp"), radius, blocks, tree_size))
    labelled = nodes.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component"))
    found = labelled.select("fp", "root").join(smallest, "root").select("fp", "component")
    return rows.join(found, "fp").select("key", "mark", "fp", "component")


def _mark(text: str):
    return F.xxhash64(F.col(f"`{text}`"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest key; columns as they are.

    A row's component follows from its own text, so rows that share a key but
    not the text are judged each by itself: a row goes only if its component
    has a smaller key. Rows of a component that share its smallest key all
    stay; rows without a key stay only where none of the component has one.
    """
    other, print_ = free_name(docs, "key", "mark")
    found = _placed(docs, key, text, shingle, radius)
    # a table, so that its size is known: it is broadcast where that is small, and no text is shuffled
    gone = saved(found.where(~F.col("key").eqNullSafe(F.col("component"))).select(
        F.col("key").alias(other), F.col("mark").alias(print_)).distinct(), "gone")
    return docs.join(gone, docs[key].eqNullSafe(gone[other]) & (_mark(text) == gone[print_]), "left_anti")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        F.col("component").alias("component_id"))
