from __future__ import annotations

import hashlib
import random
import re

import pytest

from eventide.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, size):
    """(n_words, n_hit, exact items) by comparing every stretch with every window."""
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            win = w[k:k + size]
            for p in range(len(own) - len(win) + 1):
                if own[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def near_brute(text, items, size, slop):
    """Items of which, for some place of a window's first-listed rarest term, every term is within slop of its place."""
    own, found = words(text), set()
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            win = w[k:k + size]
            for p in range(-size, len(own) + size):
                if all(any(0 <= p + j + e < len(own) and own[p + j + e] == x for e in range(-slop, slop + 1))
                       for j, x in enumerate(win)):
                    found.add(str(item))
    return found


def random_case(seed):
    rnd = random.Random(seed)
    vocab = ["a", "b", "C", "dé", "e1", "漢"]
    text = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "-"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(0, 40))) for i in range(40)] + [(100, None), (101, ""), (None, text(20)), (3, text(20)), (3, "a b c")]
    items = [(i, text(rnd.randrange(0, 9))) for i in range(12)] + [(50, None), (51, "..."), (5, "a b"), (None, "b b a")]
    return docs, items


@pytest.mark.parametrize(("seed", "segment_words", "block_windows"), [(1, 30, 10), (2, 10**6, 10**6), (3, 1, 5)])
def test_against_brute_force(spark, seed, segment_words, block_windows):
    docs, items = random_case(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dc.decontaminate(frame, bench, ["doc_id", "text"], window=4, slop=1, segment_words=segment_words,
                           block_windows=block_windows).collect()
    assert len(out) == len(docs)
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == sorted((str(a), str(b)) for a, b in docs)
    named = [("" if i is None else i, t) for i, t in items]
    for r in out:
        assert (r.n_words, r.n_hit, r["items"]) == brute(r.text, named, 4)
        assert set(r["items"]) <= set(r.near_items) == near_brute(r.text, named, 4, 1)
    assert any(set(r["items"]) < set(r.near_items) for r in out)


def test_proximity_with_unique_terms(spark):
    docs = [(0, "x one two three four five y"), (1, "one x two three four five"), (2, "two one three four five"),
            (3, "one two three"), (4, "four five"), (5, "one x x x two three four five")]
    bench = [(9, "one two three four five")]
    out = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
                           spark.createDataFrame(bench, "item_id long, text string"), ["doc_id"], slop=1)
    got = {r.doc_id: (r.n_hit, len(r.near_items)) for r in out.collect()}
    assert got == {0: (5, 1), 1: (0, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0), 5: (0, 0)}


def test_the_plan_does_not_grow_with_the_test_set(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 3 + "q r s") for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"w{i} w{i} w{i}") for i in range(200)], "item_id long, text string")
    sizes = []
    for n in (1000, 20):
        out = dc.decontaminate(docs, bench, ["doc_id"], block_windows=n)
        assert sorted(r.n_hit for r in out.collect()) == [3] * 20
        sizes.append(out._jdf.queryExecution().optimizedPlan().treeString().count("\n"))
    assert sizes[0] == sizes[1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.decontaminate(docs, bench, ["doc_id"]).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in dc.decontaminate(some, bench.limit(0), ["doc_id"]).collect()] == [0]


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "k"), (1, "z", "k"), (None, "a b", "k"), (2, None, None), (3, "x a, B", "k")],
                                 "doc_id long, text string, Fingerprint string")
    bench = spark.createDataFrame([(7, "A b")], "item_id long, text string")
    out = dc.clean(docs, bench)
    assert out.columns == docs.columns
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(["Row(doc_id=1, text='z')", "Row(doc_id=2, text=None)"])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in dc.op7_decontamination(spark, sf).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    index = {}
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            index.setdefault(tuple(w[k:k + 10]), set()).add(str(item))
    sizes, hits = {len(w) for w in index}, 0
    for r in rows:
        own, hit, found = words(r.text), set(), set()
        for n in sizes:
            for p in range(len(own) - n + 1):
                if items_of := index.get(tuple(own[p:p + n])):
                    hit.update(range(p, p + n))
                    found |= items_of
        hits += bool(hit)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (len(own), len(hit), len(found), bool(hit))
        assert g.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert hits
