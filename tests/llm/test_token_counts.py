from __future__ import annotations

import random

import public_tokenizers
import pytest
import regex

from eventide.llm import token_counts as tc

FIND = regex.compile(public_tokenizers.PATTERN)


def brute(word: bytes, scores: dict[bytes, int]) -> int:
    """Tokens of the best segmentation, trying every split (best score, then fewest tokens)."""
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        best.append(max((best[s][0] + scores[word[s:end]], best[s][1] - 1)
                        for s in range(end) if word[s:end] in scores))
    return -best[-1][1]


@pytest.fixture(scope="module")
def scores():
    return tc.zipf_scores()


def test_probabilities_sum_to_one(scores):
    import math
    assert abs(sum(math.exp(s * tc.UNIT) for s in scores.values()) - 1) < 1e-3


def test_shared_prefixes_small_tries_and_windows(scores):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("theandingé ") for _ in range(rnd.randrange(1, 30))) for _ in range(600)]
    for t in (tc.Terminals(scores), tc.Terminals(scores, max_nodes=40), tc.Terminals(scores, max_depth=3)):
        for w in words:
            assert t[w] == brute(w.encode(), scores), w


def test_same_as_the_unigram_model_of_a_public_library():
    from tokenizers import Tokenizer, models
    vocab = [("<unk>", 0.0), ("a", -3.0), ("b", -3.5), ("c", -5.0), ("ab", -4.0), ("abc", -6.5), ("bc", -5.25), ("ca", -6.75)]
    lib = Tokenizer(models.Unigram(vocab, unk_id=0))
    t = tc.Terminals({p.encode(): round(s / tc.UNIT) for p, s in vocab[1:]})
    rnd = random.Random(5)
    for _ in range(300):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 20)))
        own = sum(dict(vocab)[x] for x in lib.encode(w).tokens)
        assert abs(t.score_of(w) * tc.UNIT - own) < 1e-9


def test_very_long_pretoken(scores):
    w = "ab" * 50_000
    assert tc.Terminals(scores)[w] == tc.Terminals(scores, max_depth=10**6)[w]


def test_query_and_edges(spark, scores):
    texts = [None, "", " ", "a a a", "don't", "x" * 3000, "漢字 é", "a a a"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, N_TOKENS int")
    out = tc.count_tokens(docs)
    assert out.columns == ["doc_id", "text", "n_pretokens", "n_tokens"]
    for r in out.collect():
        pre = FIND.findall(r.text or "")
        assert (r.n_pretokens, r.n_tokens) == (len(pre), sum(brute(p.encode(), scores) for p in pre))
    assert tc.count_tokens(docs.limit(0)).count() == 0
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in tc.op1_token_counts(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows[:60]:
        pre = FIND.findall(r.text or "")
        assert got[r.doc_id].n_tokens == sum(brute(p.encode(), scores) for p in pre)
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_pretokens) == (len((r.text or "").encode()), len(pre))


def test_a_piece_of_score_zero():
    """The only piece of a vocabulary has probability one."""
    only = tc.Terminals({b"a": 0})
    assert [only.best("a" * n) for n in (1, 3)] == [(0, 1), (0, 3)]
    assert tc.Terminals({b"a": 0, b"aa": 0}).best("aaa") == (0, 2)
