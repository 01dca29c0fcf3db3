from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from eventide.llm import pieces

ODD = [None, "", " ", "\n\n  a", "x" * 5000, " " * 3000 + "x", "a" + " \t" * 2000, "don't we'll", "é ñ ß 漢字 🙂𝔘",
       "<s>", "<0x0A>", "<unk> </s>", "a\x00b", "▁a ▁▁b", "\r\n ﻿", "a" * 50 + "　" * 200 + "b", "tab\tand \r\n lines\n" * 300]


@pytest.fixture(scope="module")
def model():
    return pieces.Model(None)


@pytest.mark.parametrize("heap_from", [12, 2_048])
def test_ids_are_the_librarys(model, monkeypatch, heap_from):
    monkeypatch.setattr(pieces, "HEAP_FROM", heap_from)
    model.forget()
    rnd = random.Random(heap_from)
    pool = [model.library.id_to_piece(i).replace(pieces.MARK, " ") for i in range(259, model.size)]
    few = ["the", "in", " ", "  ", "a", "re", "▁", "é", "漢", "\n", "ing", "an"]
    texts = [t or "" for t in ODD]
    for _ in range(1500):
        texts.append("".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 30))))
        texts.append("".join(rnd.choice("abtheinrso  \n") for _ in range(rnd.randrange(1, 60))))
        texts.append("".join(rnd.choice(few) * rnd.choice((1, 1, 2, 3, 30)) for _ in range(rnd.randrange(1, 12))))
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == model.library.encode(text), repr(text[:200])


def test_memory_starts_anew_without_a_change(model, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_UNITS", 5)
    texts = ["one two three four five six seven", "one two", "", "eight nine ten eleven twelve thirteen"] * 2
    for text in texts:
        assert model.encode([text])[0].tolist() == model.library.encode(text)
    assert len(model.known) <= 6


def test_ranks_that_must_merge_alone(model):
    ids = {model.library.id_to_piece(i): i for i in range(259, model.size)}
    assert model.alone[ids["▁th"]] and model.alone[ids["▁▁"]] and not model.alone.all()


def test_long_texts(model):
    rnd = random.Random(3)
    for text in (" " * 300_000 + "b", "ab" * 100_000, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))):
        assert model.encode([text])[0].tolist() == model.library.encode(text)


def test_edge_rows(spark, model):
    rows = [(i, t, "c", 1) for i, t in enumerate(ODD)] + [(None, "a", "c", 1), (1, "", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, n_Tokens int")
    out = pieces.decode(pieces.encode(docs))
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in out.collect():
        want = [1, *model.library.encode(r.text or ""), 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == model.library.decode(want)
    both = pieces.encode(docs, decoded="TEXT_").collect()
    assert sorted(map(str, ((r.text, r.TEXT_) for r in both))) == sorted(map(str, ((r.text, r.decoded) for r in out.collect())))
    bare = pieces.encode(docs, begin=False, end=False).where("text is null").first()
    assert bare.n_tokens == 0 and bytes(bare.ids) == b""


def test_null_ids_and_empty_table(spark):
    rows = spark.createDataFrame([(None,), (bytearray(b""),)], "ids binary")
    assert [r.decoded for r in pieces.decode(rows).collect()] == [None, ""]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(docs)).count() == 0


def test_query_against_the_library(spark, model):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in pieces.op13_sentencepiece(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = model.library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got.pop(r.doc_id) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                     hashlib.sha256(model.library.decode(ids).encode()).hexdigest())
    assert not got
