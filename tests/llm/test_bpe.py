from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from eventide.llm import bpe

ODD = [None, "", " ", "\n\n  a", "x" * 5000, " " * 3000 + "x", "a" + " \t" * 2000, "don't we'll", "é ñ ß 漢字 🙂",
       "<|endoftext|>", "a" * 50 + "　" * 2000 + "b", "12 345\x1c\x1f\x85x", "tab\tand \r\n lines\n" * 300]


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(None, None)


def test_cuts_keep_the_ids(enc):
    rnd = random.Random(7)
    alphabet = "ab é'sll 漢1 2  \n\t\r　\xa0.,!-_"
    for _ in range(400):
        text = "".join(rnd.choice(alphabet) * rnd.choice((1, 1, 1, 2, 9)) for _ in range(rnd.randrange(1, 90)))
        assert bpe.encode_text(enc, text, size=5, long_blank=3) == enc.encode_ordinary(text), repr(text)
    for text in ODD[1:]:
        assert bpe.encode_text(enc, text, size=40, long_blank=20) == enc.encode_ordinary(text)


def test_a_million_blanks(enc):
    ids = bpe.encode_text(enc, "a" + " " * 1_000_000 + "b")
    assert enc.decode_bytes(ids) == b"a" + b" " * 1_000_000 + b"b"


def test_edge_rows_round_trip(spark, enc):
    rows = [(i, t, "c", 1) for i, t in enumerate(ODD)] + [(None, "a", "c", 1), (1, "", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, n_Tokens int")
    out = bpe.decode(bpe.encode(docs))
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in out.collect():
        text = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.n_tokens == len(r.ids) // 4


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(None,), (bytearray(b""),)], "ids binary")
    assert [r.decoded if r.decoded is None else bytes(r.decoded) for r in bpe.decode(rows).collect()] == [None, b""]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs)).count() == 0


def test_query_against_the_library(spark, enc):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op9_byte_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text or "")
        assert got.pop(r.doc_id) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                     hashlib.sha256((r.text or "").encode()).hexdigest())
    assert not got
