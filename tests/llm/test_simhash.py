from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from eventide.llm import simhash as sh


def brute_fp(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keyed, radius):
    """key -> smallest key reached, comparing all fingerprints."""
    parent = list(range(len(keyed)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keyed)):
        for j in range(i):
            if (keyed[i][1] ^ keyed[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(keyed):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(keyed))]


ODD = [None, "", " \n", "a", "A", "a b c", "a b c d", "A B C\xa0D É é", "w " * 60_000]


def test_fingerprints(monkeypatch):
    rnd = random.Random(4)
    texts = ODD + [" ".join(rnd.choice("abcÉ") for _ in range(rnd.randrange(30))) for _ in range(100)]
    want = [brute_fp(t, 4) for t in texts]
    assert [sh.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(sh, "CHUNK", 3)
    assert [sh.fingerprint(t) for t in texts[:8] + texts[9:]] == want[:8] + want[9:]


def near_values(seed, n):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(6)]
    out = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(7))) & (2**64 - 1) for b in base for _ in range(n)}
    return sorted(out | {0, 1, 2**64 - 1, 2**63} | {rnd.getrandbits(64) for _ in range(n)})


def test_tree_finds_what_brute_force_finds():
    v = np.array(near_values(1, 60), np.uint64)
    child = sh.bk_tree(v)
    assert sorted(child[child >= 0].tolist()) == list(range(1, len(v)))
    got = {(int(a), int(b)) for q, n in sh.lookups(v, child, v, 4) for a, b in zip(q, n, strict=True)}
    want = {(i, j) for i in range(len(v)) for j in range(len(v)) if (int(v[i]) ^ int(v[j])).bit_count() <= 4}
    assert got == want and len(want) > 2 * len(v)


@pytest.mark.parametrize(("blocks", "tree_size"), [(5, 2048), (6, 30), (8, 5), (None, 3)])
def test_components_against_brute_force(spark, blocks, tree_size):
    values = near_values(7, 25)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    edges = sh.links(frame, 4, blocks, tree_size)
    roots = {r.node: r.root for r in sh.components(edges).collect()}
    want = brute_components(list(zip(signed, values, strict=True)), 4)
    assert [roots.get(v, v) for v in signed] == want
    assert edges.count() <= 3 * len(values) * (70 if blocks == 8 else 15)


def test_long_chain_and_no_edges(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(150)], "a long, b long")
    got = sh.components(chain).collect()
    assert len(got) == 150 and {r.root for r in got} == {0}
    assert sh.components(chain.limit(0)).count() == 0


def docs_of(spark):
    rnd = random.Random(9)
    texts = list(ODD)
    for _ in range(8):
        words = [rnd.choice("abcdefghijklmnop") * rnd.randrange(1, 5) for _ in range(120)]
        for _ in range(4):
            texts.append(" ".join(words))
            words = list(words)
            words[rnd.randrange(len(words))] = "zz"
    rows = [(None if i % 7 == 3 else 100 - i, t, "x") for i, t in enumerate(texts)] + [(90, "q r s t u v", "x"), (90, "q r s t u v", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, FP string"), rows


def test_documents(spark):
    docs, rows = docs_of(spark)
    out = sh.near_duplicates(docs).collect()
    fps = [brute_fp(t, 4) for _, t, _ in rows]
    want = brute_components([(k, f) for (k, *_), f in zip(rows, fps, strict=True)], 4)
    assert sorted(str((r.doc_id, r.fp % 2**64, r.component)) for r in out) == sorted(
        str((k, f, c)) for (k, *_), f, c in zip(rows, fps, want, strict=True))
    assert sh.near_duplicates(docs.limit(0)).count() == 0
    kept = sh.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        str((k, t)) for (k, t, _), c in zip(rows, want, strict=True) if k == c)


def test_rows_of_one_key_and_unlike_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    rows = [(7, a), (7, b), (3, b), (9, a), (None, a), (None, c), (5, c), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, sh.keep_one(docs).collect()), key=str)
    assert kept == sorted([(7, a), (3, b), (5, c), (5, None)], key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in sh.op4_simhash(spark, sf).collect()}
    rows = [(r.doc_id, brute_fp(r.text, 4)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_components(rows, 4)
    assert got == {k: (f"{f:016x}", c) for (k, f), c in zip(rows, want, strict=True)}
    assert any(k != c for (k, _), c in zip(rows, want, strict=True))
