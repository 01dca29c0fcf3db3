from __future__ import annotations

import random
import re

import numpy as np
import pytest

from eventide.llm import quality as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    where = {}
    for k in range(len(words) - 4):
        where.setdefault(tuple(words[k:k + 5]), []).append(k)
    repeat = {k + j for at in where.values() if len(at) > 1 for k in at for j in range(5)}
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat)


ODD = [None, "", " \n", "a", "a b c d e a b c d e", "a " * 5, "a " * 6, "x\x85y z\xa0w", "l\nl\n\n\n l\nl", "# $ é|<", "a\x1cb " * 9,
       "one two three four five six seven eight nine ten", "W" * 10_000]


def test_statistics_against_brute_force():
    rnd = random.Random(1)
    texts = ODD + [" ".join(rnd.choice("abc") + rnd.choice(["", "\n", "é"]) for _ in range(rnd.randrange(40))) for _ in range(400)]
    for t in texts:
        assert q.statistics(t)[:5] == brute(t), repr(t)
        words = (t or "").encode().split()
        assert q.repeated_words(words) == q.repeated_words(words, small=0)


def test_monotonic_and_flat_scoring():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(3000, 4))
    y = ((x[:, 0] + np.sin(3 * x[:, 1]) + rnd.normal(size=3000) * 0.5) < 0).astype(float)
    trees = q.fit(x, y, [-1, 0, 1, 0])
    for f, sign in ((0, -1), (2, 1)):
        at = np.repeat(x[:200], 30, axis=0)
        at[:, f] = np.tile(np.linspace(-4, 4, 30), 200)
        steps = np.diff(trees.score(at).reshape(200, 30), axis=1) * sign
        assert (steps >= -1e-12).all()

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x[:300]), [walk(r) for r in x[:300]])
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.8


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    trees = q.train(docs, labels.where("doc_id % 2 = 0"))
    rest = q.judge(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), trees).select("quality", "quality_rules.score").collect()
    right = np.mean([(r.score >= q.KEEP_FROM) == (r.quality == 1) for r in rest])
    kept = np.mean([r.score >= q.KEEP_FROM for r in rest if r.quality == 1])
    assert right > 0.97 and kept > 0.98, (right, kept)


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(None, 1), (2, None)], [(11, 1), (12, 0), (12, 1)]])
def test_edges(spark, labelled):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(ODD)] + [(11, "x", True), (None, "y", False)],
                                 "doc_id long, text string, Kept boolean")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    trees = q.train(docs, labels)
    out = q.judge(docs, trees)
    for r in out.collect():
        n_words, *_, repeats = want = brute(r.text)
        v = r.quality_rules
        assert tuple(v)[:5] == want and v.base_failed == (n_words < 10 or 100 * repeats > 20 * n_words)
        assert v.kept == (not v.base_failed and v.score >= q.KEEP_FROM)
    kept = q.keep_good(docs, trees)
    assert kept.columns == docs.columns and kept.count() == out.where("quality_rules.kept").count()
    assert q.judge(docs.limit(0), trees).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in q.op8_quality_rules(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert tuple(got[r.doc_id])[1:6] == brute(r.text)
