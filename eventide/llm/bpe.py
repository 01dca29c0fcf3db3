"""Byte-level BPE encoding and decoding with a local rank file.

The ranks come from a file named by a parameter and are loaded once per Python
worker by the tiktoken library. Texts longer than ``CHUNK`` characters are cut
where a match of the pattern surely ends, so that no call sees an unbounded
text: between a letter or digit and a blank, and inside a run of white space
only as the pattern itself cuts it. Every cut leaves the ids unchanged.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import free_name, table

#: Characters that go to the library in one call, about.
CHUNK = 16_384
#: A white-space run from this length on is cut out and encoded as the one piece that it is.
LONG_BLANK = 1_000

#: White space as the library's pattern engine defines it (Unicode White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A letter or digit before a blank: no alternative of the pattern crosses from one to the other.
SAFE = re.compile(r"(?<=[^\W_])(?=[ \n])")


def default_ranks() -> str:
    """Place of the 50k byte-level rank file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str | None, pattern: str | None):
    """The library's encoder, one per worker process and rank file."""
    import public_tokenizers
    import tiktoken

    with open(rank_file or default_ranks(), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern or public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int = CHUNK):
    """``text`` in parts that begin and end where matches of the pattern do."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end
    if start < len(text):
        yield text[start:]


def encode_text(enc, text: str, size: int = CHUNK, long_blank: int = LONG_BLANK) -> list[int]:
    """Ids of a whole text, equal to ``enc.encode_ordinary(text)``.

    In a white-space run before other text the pattern takes all but the last
    character as one match, and a run that ends the text whole; such a match is
    encoded directly. (Over some hundred thousand blanks the library's pattern
    engine runs out of stack.) A single very long word stays one piece.
    """
    if len(text) <= min(size, long_blank):
        return enc.encode_ordinary(text)
    ids: list[int] = []
    runs = re.compile(f"[{WHITE}]{{{max(2, long_blank)},}}")
    start = 0
    for run in runs.finditer(text):
        for part in chunks(text[start:run.start()], size):
            ids += enc.encode_ordinary(part)
        start = run.end() - (run.end() < len(text))
        ids += enc._encode_single_piece(text[run.start():start].encode())
    for part in chunks(text[start:], size):
        ids += enc.encode_ordinary(part)
    return ids


def _binaries(data: bytearray, ends: list[int], null: pa.Array | None = None) -> pa.Array:
    """An array of byte strings on top of one buffer, without a copy of each."""
    out = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(data)])
    return out if null is None else pc.if_else(null, pa.scalar(None, pa.binary()), out)


def _encoder(rank_file: str | None, pattern: str | None):
    @F.arrow_udf("struct<n_tokens:bigint,ids:binary>")
    def encode(texts: pa.Array) -> pa.Array:
        enc = encoding(rank_file, pattern)
        packed, ends = bytearray(), [0]
        for text in texts:
            packed += np.array(encode_text(enc, text.as_py() or ""), dtype="<u4").tobytes()
            ends.append(len(packed))
        return pa.StructArray.from_arrays([pa.array(np.diff(ends) // 4, pa.int64()), _binaries(packed, ends)],
                                          ["n_tokens", "ids"])

    return encode


def _decoder(rank_file: str | None, pattern: str | None):
    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        enc = encoding(rank_file, pattern)
        raw, ends = bytearray(), [0]
        for x in ids:
            raw += enc.decode_bytes(np.frombuffer(x.as_py() or b"", "<u4").tolist())
            ends.append(len(raw))
        return _binaries(raw, ends, ids.is_null() if ids.null_count else None)

    return decode


def encode(docs: DataFrame, text: str = "text", rank_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned 32-bit).

    A null or empty text has no tokens. Input columns named like the two new
    ones give way. Strings of special tokens are ordinary text. ``rank_file``
    is opened on the executors; None is the installed 50k file.
    """
    new = ("n_tokens", "ids")
    found, = free_name(docs, "encoded")
    out = docs.withColumn(found, _encoder(rank_file, pattern)(F.col(f"`{text}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new],
                      *[F.col(f"{found}.{c}") for c in new])


def decode(encoded: DataFrame, ids: str = "ids", into: str = "decoded", rank_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``encoded`` with the raw bytes that ``ids`` stand for (null ids: null).

    Bytes, not text: ids may end inside a character.
    """
    return encoded.withColumn(into, _decoder(rank_file, pattern)(F.col(f"`{ids}`")))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, and digests of its ids and of the decoded bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs))
    return both.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
