from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventide.llm import maxent_lm as lm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def held_out(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def brute(rows):
    """Base columns by the definition."""
    c = Counter(w for k, t in rows if not held_out(k) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for k, t in rows:
        own = tokens(t)
        out.append((k, held_out(k), len(own), sum(w in c for w in own), n,
                    sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)))
    return out, c


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    words = [f"w{i}".encode() for i in range(700)]
    counts = np.sort(rng.integers(3, 4000, 700))[::-1].astype(float)
    tail_tokens, tail_words = np.zeros(lm.TAIL_CLASSES), np.zeros(lm.TAIL_CLASSES)
    for w, c in zip(words, counts, strict=True):
        tail_tokens[lm.tail_class(w)] += c
        tail_words[lm.tail_class(w)] += 1
    voc = lm.Vocabulary(words, counts, int(counts.sum()), 700, 0.4, tail_tokens, tail_words)
    model = lm.Model.start(voc)
    trainer = lm.Trainer(model, 1.0)
    texts = [rng.integers(0, 700, 300).astype(np.int32) for _ in range(20)]
    texts += [np.tile(np.arange(5, dtype=np.int32), 400)] * 4
    trainer.learn(texts)
    return model, voc


def test_probabilities_of_all_words_sum_to_one():
    model, voc = small_model()
    assert len(voc.node_bias) > lm.BRANCH and set(voc.cls[:700]) == set(range(lm.BRANCH))
    empty = [lm.HEAD + k for k in range(lm.TAIL_CLASSES)]
    for history in ([], [3], [1, 2], [650, 4], [lm.HEAD + 2, 9]):
        known = sum(10 ** model.log_probs([np.array([*history, w], np.int32)])[-1] for w in range(700))
        unseen = sum(10 ** (model.log_probs([np.array([*history, e], np.int32)])[-1] + u)
                     for e, u in zip(empty, voc.log_unseen(), strict=True))
        assert abs(known + unseen - 1) < 1e-4


def test_learns_and_batches_alike(monkeypatch):
    model, voc = small_model()
    run = np.tile(np.arange(5, dtype=np.int32), 40)
    assert model.log_probs([run])[10:].mean() > lm.Model.start(voc).log_probs([run])[10:].mean() + 0.5
    texts = [run, np.array([4], np.int32), np.arange(690, dtype=np.int32)]
    whole = model.log_probs(texts)
    monkeypatch.setattr(lm, "BATCH", 7)
    assert np.allclose(whole, model.log_probs(texts))
    assert np.allclose(whole, np.concatenate([model.log_probs([t]) for t in texts]))


def plain_log_prob(model, history, word):
    """log10 of a number's probability after two numbers, feature by feature and node by node."""
    voc = model.voc
    r1, r2 = (int(voc.row[h]) for h in history)
    mix = lambda a, b, rows: ((a * 0x1F3D5B79 + b * 0x2545F491 + 0x3C6EF372) >> 7) * 0x27D4EB2F >> 11 & (rows - 1)

    def factor(tables, rows, bias, chosen):
        logits = [float(bias[k]) + sum(float(tables[r][k]) for r in rows) for k in range(len(bias))]
        top = max(logits)
        return math.log10(math.exp(logits[chosen] - top) / sum(math.exp(x - top) for x in logits))

    n = voc.rows
    total = factor(model.by_class, [r1, n + r2, 2 * n + mix(r1, r2, 2 * n)], model.class_bias, int(voc.cls[word]))
    for level in range(lm.LEVELS):
        node = int(voc.node[level, word])
        if node >= 0:
            skip = [] if level else [2 * n + mix(node, r2, 2 * n)]
            total += factor(model.by_node, [mix(node, r1, 2 * n), *skip], voc.node_bias[node], int(voc.child[level, word]))
    return total


def test_group_sums():
    rng = np.random.default_rng(2)
    for n, most in ((1, 1), (50, 3), (400, 90)):
        sizes = rng.integers(1, most + 1, n)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        rows = rng.random((int(sizes.sum()), 4)).astype(np.float32)
        assert np.allclose(lm.group_sums(rows, starts, sizes), [rows[a:a + k].sum(axis=0) for a, k in zip(starts, sizes, strict=True)], rtol=1e-4)


def test_scores_against_brute_force():
    model, _ = small_model(3)
    rnd = np.random.default_rng(5)
    texts = [rnd.integers(0, 700, n).astype(np.int32) for n in (1, 2, 40)] + [np.array([lm.HEAD + 3, 5, lm.HEAD], np.int32)]
    want = [plain_log_prob(model, (t[i - 1] if i else lm.START, t[i - 2] if i > 1 else lm.START), t[i])
            for t in texts for i in range(len(t))]
    assert np.allclose(model.log_probs(texts), want, atol=1e-4)


@pytest.mark.parametrize("head", [lm.HEAD, 8])
def test_the_untrained_query_is_the_count_model(spark, monkeypatch, head):
    """Without a round every score follows from the counts: shares along the tree multiply to a word's own,
    rare words are discounted, words never seen share the rest."""
    if head == 8:  # only words with counts of 8 and more are numbered
        def cut(counts, whole=lm.vocabulary):
            voc, _ = whole(counts)
            top = counts.where(lm.count_step() >= 48).orderBy(lm.F.desc("c"), "word").toArrow()
            tokens, words = np.zeros(lm.TAIL_CLASSES), np.zeros(lm.TAIL_CLASSES)
            for r in counts.collect():
                tokens[lm.tail_class(bytes(r.word))] += r.c
                words[lm.tail_class(bytes(r.word))] += 1
            return lm.Vocabulary(top.column("word").to_pylist(), top.column("c").to_numpy().astype(float), voc.n, voc.v,
                                 voc.discount, tokens, words), 48

        monkeypatch.setattr(lm, "vocabulary", cut)

    rows = [(k, t) for k, t in ROWS] + [(20 + i, "a a a a a a a a a b b c d%d zebra the" % i) for i in range(9)]
    c = Counter(w for k, t in rows if not held_out(k) for w in tokens(t))
    numbered = {w for w, n in c.items() if n >= (1 if head != 8 else 8)}
    once, twice = (sum(n == x for n in c.values()) for x in (1, 2))
    discount = once / (once + 2 * twice) if once and twice else 0.5
    kind = lambda w: lm.tail_class(w.encode())
    rest = [sum(n for w, n in c.items() if w not in numbered and kind(w) == k) for k in range(lm.TAIL_CLASSES)]
    size = [sum(w not in numbered and kind(w) == k for w in c) for k in range(lm.TAIL_CLASSES)]
    whole = sum(n for w, n in c.items() if w in numbered) + sum(r + 0.5 for r in rest)

    def log(w):
        if w in numbered:
            return math.log10(c[w] / whole)
        k = kind(w)
        share = (c[w] - discount) / rest[k] if w in c else discount * size[k] / rest[k] if rest[k] else 1.0
        return math.log10((rest[k] + 0.5) / whole * share)

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_texts(docs, rates=()).collect())
    want = sorted((str(k), len(tokens(t)), sum(map(log, tokens(t)))) for k, t in rows)
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-3 * max(1, abs(w[2])), (g, w)


ROWS = [(1, None), (2, ""), (3, "The the THE\xa0é"), (4, "the cat"), (None, "the dog"), (4, "the cat"), (9, "x " * 3000)]


@pytest.mark.parametrize("rows", [ROWS, [(k, t) for k, t in ROWS if held_out(k)] + [(k, "a b") for k in range(200) if held_out(k)][:3]])
def test_edges(spark, rows):
    docs = spark.createDataFrame([(k, t, 1.0) for k, t in rows], "doc_id long, text string, SCORE double")
    got = sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in lm.score_texts(docs).collect())
    want, _ = brute(rows)
    assert got == sorted(str((*w[:5], round(w[5], 6) + 0.0)) for w in want)
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_query_base_and_gain(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want, c = brute(rows)
    got = {r.doc_id: r for r in lm.op2_maxent_lm(spark, sf).collect()}
    assert len(got) == len(rows)
    for w in want:
        r = got[w[0]]
        assert tuple(r)[1:5] == w[1:5] and abs(r.base_score - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 0.93
    frame = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    start = {r.doc_id: r.score for r in lm.score_texts(frame, rates=()).collect()}
    assert sum(r.score for r in out) > sum(start[r.doc_id] for r in out)


def test_rounds_after_the_first_learn_from_averaged_weights(spark, monkeypatch):
    """Several trainers: more rounds do better on held-out texts than one."""
    monkeypatch.setattr(lm, "TRAINER_TOKENS", 100_000)
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(8)
    total = lambda rates: lm.score_texts(frame, rates=rates).where("held_out").agg({"score": "sum"}).first()[0]
    assert total(lm.RATES) > total(lm.RATES[:1])
