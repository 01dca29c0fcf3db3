"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from eventide.llm import bpe, common, quality
from test_decontamination import words
from test_line_dedup import brute as brute_lines
from test_quality import brute as brute_stats
from test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    trees = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    x = quality.features(np.array([quality.statistics(t) for t in docs.values()]))
    good = trees.score(x) >= quality.KEEP_FROM
    left = {}
    for (k, t), ok in zip(docs.items(), good, strict=True):
        n, *_, repeats = brute_stats(t)
        if ok and n >= 10 and 100 * repeats <= 20 * n:
            left[k] = t
    assert 0 < len(left) < len(docs)
    left = dict(zip(left, (t for t, *_ in brute_lines(list(left.values()), 10)), strict=True))
    keyed = [(k, brute_fp(t, 4)) for k, t in left.items()]
    left = {k: left[k] for (k, _), c in zip(keyed, brute_components(keyed, 4), strict=True) if k == c}
    index = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        index |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    clean = {}
    for k, t in left.items():
        w = words(t)
        if not any(tuple(w[p:p + n]) in index for n in {len(i) for i in index} for p in range(len(w) - n + 1)):
            clean[k] = t
    assert len(clean) < len(left)
    before = common.made()
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert common.made() == before + 1  # the result alone is left
    assert sorted(out) == sorted(clean)
    enc = bpe.encoding(None, None)
    for k, t in clean.items():
        assert out[k].text == t and out[k].n_chars == len(t)
        assert np.frombuffer(out[k].ids, "<u4").tolist() == enc.encode_ordinary(t)


def test_stages_keep_columns_and_odd_rows(spark):
    """Nulls, empty texts, repeats and clashing columns pass every stage; so does an empty table."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, "en", "s", 1, "a"), (1, long, "en", "s", 1, "a"), (None, long + " x", None, None, None, None),
            (2, None, "en", "s", 0, "b"), (3, "", "en", "s", 0, "b"), (4, "short", "en", "s", 5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Fingerprint string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.columns[:len(docs.columns)] == docs.columns, name
            out.collect()
            if name != "byte_bpe":
                assert out.columns == docs.columns
