from __future__ import annotations

import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import sharding as sh


def test_draws_follow_the_distribution(spark):
    total, marked, drawn, n = 30, 11, 9, 20_000
    got = Counter(r.x for r in spark.range(n).select(
        sh.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), sh.uniform("id")).alias("x")).collect())
    chi = 0
    for v in range(10):
        p = comb(marked, v) * comb(total - marked, drawn - v) / comb(total, drawn)
        if n * p > 5:
            chi += (got[v] - n * p) ** 2 / (n * p)
    assert chi < 35 and set(got) <= set(range(10))


@pytest.mark.parametrize("case", [(0, 0, 0), (5, 5, 3), (5, 0, 3), (5, 2, 5), (5, 2, 0), (1, 1, 1), (10**6, 5 * 10**5, 5 * 10**5)])
def test_draws_at_the_edges(spark, case):
    total, marked, drawn = case
    for u in (0.0, 0.5, 1 - 2 ** -53):
        x = spark.range(1).select(sh.hypergeometric(*map(F.lit, case), F.lit(u)).alias("x")).first().x
        assert max(0, drawn - (total - marked)) <= x <= min(drawn, marked)


def test_matrix_margins(spark):
    counts = [7, 0, 13, 100, 1, 22, 9]
    room = [51, 51, 50]
    rows = sh.communication_matrix(spark.createDataFrame([(counts,)], "counts array<long>"),
                                   F.array(*[F.lit(x).cast("long") for x in room]), 3, len(counts)).collect()
    m = np.array([r.room for r in sorted(rows, key=lambda r: r.part)])
    assert m[:7].sum(1).tolist() == counts and m.sum(0).tolist() == room and (m >= 0).all() and not m[7:].any()


def check(out, n, shards):
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize(("n", "shards", "parts", "block"), [(0, 4, 1, 10), (1, 4, 1, 10), (3, 24, 2, 10), (400, 7, 70, 20)])
def test_exact_sizes_and_gapless_slots(spark, n, shards, parts, block):
    rows = spark.range(n).select((F.col("id") % 3).alias("doc_id"), F.lit("x").alias("SLOT"), F.lit(None).cast("string").alias("part")).repartition(parts)
    frame = sh.shard(rows, shards, seed=5, block_rows=block)
    assert frame.columns == ["doc_id", "part", "shard", "slot"]
    out = frame.collect()
    check(out, n, shards)
    assert Counter(r.doc_id for r in out) == Counter(i % 3 for i in range(n))


def test_uniform(spark):
    """Where a row comes from tells nothing of its shard or of its place in the shard."""
    n, shards = 20_000, 5
    out = sh.shard(spark.range(0, n, 1, 4), shards, seed=11, block_rows=700).collect()
    table = np.zeros((8, shards * 4))
    for r in out:
        table[r.id * 8 // n, r.shard * 4 + min(3, r.slot * 4 * shards // n)] += 1
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    assert ((table - expected) ** 2 / expected).sum() < 133 + 6 * (2 * 133) ** 0.5
    follows = {(r.shard, r.slot): r.id for r in out}
    steps = [follows[s, k + 1] - v for (s, k), v in follows.items() if (s, k + 1) in follows]
    assert 0.47 < np.mean([x > 0 for x in steps]) < 0.53 and sum(x == 1 for x in steps) < 12


def test_query_and_repeatability(spark):
    sf = "/root/testdata/sf0.001"
    out = sh.op10_sharding(spark, sf).collect()
    rows = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(out, len(rows), 24)
    for r in out:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(rows[r.doc_id]) + 8, zlib.crc32(rows[r.doc_id]), "rows", None)
    assert sorted(out) == sorted(sh.op10_sharding(spark, sf).collect())
