"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

The model's file gives normalisation, pieces and scores. A normalised text is
cut into units that no piece can cross: before a word mark that follows
something else, and around line feeds. Units are encoded once per worker and
looked up from then on; all new units of a batch are encoded together. Their
characters lie in one flat numpy array of symbols, and a round

1. looks up the rank of every two neighbours within a unit,
2. takes each unit's minimum (a segmented reduction),
3. merges the leftmost pairs that have it, none overlapping another, in all
   units at once,
4. compacts the array, and takes out the units without a pair.

It ends when no pair is left. A sequential encoder merges one pair at a time;
several merges of a rank may share a round only where nothing that the first
makes possible could come before the second. Ranks whose piece occurs, not at
the end, in a piece of the same or a better rank are therefore merged one at
a time (``Model.alone``). Units that would need very many rounds (thousands of
blanks, or one enormous word) are merged in rank order from a heap instead,
with the same result.
"""

from __future__ import annotations

import functools
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.bpe import _binaries
from eventide.llm.common import free_name, table

#: Fixed value: the mark that stands for a blank in normalised text.
MARK = "▁"
#: Units a worker remembers; then it starts anew, which changes no result.
MAX_UNITS = 100_000
#: Tokens of all units that a worker remembers, likewise.
MAX_TOKENS = 1_000_000
#: Characters of texts that are encoded together, about; one text is never split over two batches.
BATCH_CHARS = 500_000
#: Symbols of a unit from which on it is merged from a heap instead of in rounds.
HEAP_FROM = 2_048
#: No pair.
NONE = np.int32(2**31 - 1)
#: Symbols stand in this many bits: ids of pieces, and from ``Model.size`` on code points without a piece.
BITS = 22


def default_model() -> str:
    """Place of the 32k model on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pairs:
    """Whole numbers by pairs of symbols, looked up for whole arrays: a hash table with as many planes as its fullest slot has keys."""

    FREE = -1

    def __init__(self, of: dict[int, int]):
        keys = np.array(list(of), np.int64)
        self.shift = np.uint64(64 - max(8, int(len(of) * 4).bit_length()))
        slots = self.slots(keys)
        order = np.argsort(slots, kind="stable")
        ranked = slots[order]
        heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        plane = np.arange(len(ranked)) - np.repeat(heads, np.diff(heads, append=len(ranked)))
        shape = (int(plane.max()) + 1, 1 << (64 - int(self.shift)))
        self.keys, self.values = np.full(shape, self.FREE, np.int64), np.full(shape, self.FREE, np.int32)
        self.keys[plane, ranked] = keys[order]
        self.values[plane, ranked] = np.array(list(of.values()), np.int32)[order]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 if it has none."""
        slots = self.slots(keys)
        found = self.keys[0][slots]
        out = np.where(found == keys, self.values[0][slots], self.FREE)
        rest = np.flatnonzero((found != keys) & (found != self.FREE))
        for known, values in zip(self.keys[1:], self.values[1:], strict=True):
            if not len(rest):
                break
            found = known[slots[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = values[slots[rest[hit]]]
            rest = rest[~hit & (found != self.FREE)]
        return out


@functools.lru_cache(maxsize=2)
def library(path: str | None):
    """The library's processor, one per worker process and model."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or default_model())


class Model:
    """Tables of a BPE model with byte fallback, from the library's view of its file."""

    def __init__(self, path: str | None):
        self.library = sp = library(path)
        self.size = size = sp.vocab_size()
        pieces, self.byte = {}, np.zeros(256, np.int64)
        scores = np.array([sp.get_score(i) for i in range(size)])
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[piece] = i
        if not self.byte.all():
            raise ValueError("a model without byte pieces")
        if any(MARK in piece.lstrip(MARK) for piece in pieces):
            raise ValueError("a model whose pieces go on over a word mark")
        #: Rank of every piece: 0 is merged first, equal scores have equal ranks.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        symbol = dict(pieces)
        for piece in pieces:
            symbol.update((c, size + ord(c)) for c in piece if c not in symbol)
        merged = {}
        for piece, i in pieces.items():
            for k in range(1, len(piece)):
                a, b = symbol.get(piece[:k]), symbol.get(piece[k:])
                if a is not None and b is not None:
                    merged[a << BITS | b] = i
        #: The piece that a pair of symbols makes.
        self.made = Pairs(merged)
        self.of = merged
        self.char = np.arange(size, size + 0x110000, dtype=np.int64)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        #: Two characters that stand beside each other in some piece.
        self.beside = Pairs({ord(p[k]) << BITS | ord(p[k + 1]): 0 for p in pieces for k in range(len(p) - 1)})
        self.alone = np.zeros(size, bool)
        for piece, i in pieces.items():
            inner = piece[:-1]
            for a in range(len(inner)):
                for b in range(a + 2, len(inner) + 1):
                    m = pieces.get(inner[a:b])
                    if m is not None and self.rank[i] <= self.rank[m]:
                        self.alone[m] = True
        line = "" if any("\n" in p and len(p) > 1 for p in pieces) else "\n"
        #: Units of a normalised text.
        self.units = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (f"|{line}" if line else ""))
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.known: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        """An empty memory of units."""
        self.known.clear()
        self.tokens = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def heap(self, symbols: list[int]) -> list[int]:
        """The merges of one unit in order of rank, leftmost first, from a heap."""
        n = len(symbols)
        symbols, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (m := self.of.get(symbols[i] << BITS | symbols[j])) is not None:
                heapq.heappush(queue, (int(self.rank[m]), i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            if symbols[i] != a or (j := right[i]) >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = self.of[a << BITS | b], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [s for s in symbols if s >= 0]

    def merge(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of the units one after the other, and the unit of each."""
        points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.int64)
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        symbols = self.char[points]
        # within a unit, characters that no piece has side by side never meet: segments end there too
        cut = np.ones(len(points), bool)
        cut[1:] = (unit[1:] != unit[:-1]) | (self.beside(points[:-1] << BITS | points[1:]) < 0)
        place = np.arange(len(points))
        ends = np.flatnonzero(cut)
        done_symbols, done_places = [], []
        for k in np.flatnonzero(np.diff(ends, append=len(points)) >= HEAP_FROM):
            a, b = ends[k], ends[k + 1] if k + 1 < len(ends) else len(points)
            final = self.heap(symbols[a:b].tolist())
            done_symbols.append(np.array(final, np.int64))
            done_places.append(a + np.arange(len(final)))
            place[a:b] = -1
        live = place >= 0
        symbols, place, first = symbols[live], place[live], cut[live]
        while len(symbols):
            starts = np.flatnonzero(first)
            made = np.full(len(symbols), -1, np.int32)
            inner = np.flatnonzero(~first) - 1
            made[inner] = self.made(symbols[inner] << BITS | symbols[inner + 1])
            rank = np.where(made >= 0, self.rank[made], NONE)
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(symbols))
            chosen = (rank == np.repeat(least, sizes)) & (rank < NONE)
            at = np.flatnonzero(chosen)
            # of candidates in a row every other one, from the left
            row = np.ones(len(at), bool)
            row[1:] = at[1:] != at[:-1] + 1
            heads = np.flatnonzero(row)
            at = at[(np.arange(len(at)) - np.repeat(heads, np.diff(heads, append=len(at)))) % 2 == 0]
            segment = (np.cumsum(first) - 1)[at]
            again = np.zeros(len(at), bool)
            again[1:] = segment[1:] == segment[:-1]
            at = at[~(again & self.alone[made[at]])]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            idle = np.repeat(least == NONE, sizes)
            if idle.any():
                done_symbols.append(symbols[idle])
                done_places.append(place[idle])
                keep &= ~idle
            symbols, place, first = symbols[keep], place[keep], first[keep]
        places = np.concatenate(done_places) if done_places else np.zeros(0, np.int64)
        order = np.argsort(places, kind="stable")
        symbols = np.concatenate(done_symbols)[order] if done_places else places
        return symbols, unit[places[order]]

    def spelled(self, symbols: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids: a character without a piece is its bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, unit
        spelt = [self.byte[list(chr(s - self.size).encode())] for s in symbols[odd].tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[odd] = [len(s) for s in spelt]
        out = np.repeat(symbols, sizes)
        out[np.repeat(symbols >= self.size, sizes)] = np.concatenate(spelt)
        return out, np.repeat(unit, sizes)

    def learn(self, units: list[str]) -> None:
        """Encode new units and remember them."""
        ids, unit = self.spelled(*self.merge(units))
        sizes = np.bincount(unit, minlength=len(units))
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units)), strict=True))
        self.tokens = np.concatenate([self.tokens, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, without begin and end."""
        units = [self.units.findall(self.library.normalize(t)) if t else [] for t in texts]
        new = set().union(*units) - self.known.keys()
        if len(self.known) + len(new) > MAX_UNITS:
            self.forget()
            new = set().union(*units)
        if new:
            self.learn(list(new))
        out = []
        for found in units:
            which = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
            begin, sizes = self.starts[which], self.starts[which + 1] - self.starts[which]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.tokens[np.arange(total) + np.repeat(begin - (ends - sizes), sizes)])
        if len(self.known) > MAX_UNITS or len(self.tokens) > MAX_TOKENS:
            self.forget()
        return out


@functools.lru_cache(maxsize=2)
def model(path: str | None) -> Model:
    """This worker's model."""
    return Model(path)


def _groups(texts):
    """Consecutive texts of about ``BATCH_CHARS`` characters."""
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= BATCH_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _encoder(path: str | None, begin: bool, end: bool, back: bool):
    kind = "struct<n_tokens:bigint,ids:binary" + (",text:string>" if back else ">")

    @F.arrow_udf(kind)
    def encode(texts: pa.Array) -> pa.Array:
        own = model(path)
        head = np.array([own.bos] * begin, "<u4")
        tail = np.array([own.eos] * end, "<u4")
        packed, ends, raw, stops = bytearray(), [0], bytearray(), [0]
        for group in _groups(x.as_py() or "" for x in texts):
            for inner in own.encode(group):
                ids = np.concatenate([head, inner.astype("<u4"), tail])
                packed += ids.tobytes()
                ends.append(len(packed))
                if back:
                    raw += own.library.decode(ids.tolist()).encode()
                    stops.append(len(raw))
        columns = [pa.array(np.diff(ends) // 4, pa.int64()), _binaries(packed, ends)]
        if back:
            return pa.StructArray.from_arrays([*columns, _binaries(raw, stops).cast(pa.string())], ["n_tokens", "ids", "text"])
        return pa.StructArray.from_arrays(columns, ["n_tokens", "ids"])

    return encode


def _decoder(path: str | None):
    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        own = library(path)
        raw, ends = bytearray(), [0]
        for x in ids:
            raw += own.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()).encode()
            ends.append(len(raw))
        return _binaries(raw, ends, ids.is_null() if ids.null_count else None).cast(pa.string())

    return decode


def encode(docs: DataFrame, text: str = "text", model_file: str | None = None, begin: bool = True,
           end: bool = True, decoded: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned 32-bit).

    The ids are the library's for the whole text, with its begin and end ids if
    asked for; a null or empty text has no others. ``decoded`` names a column
    for the text that the ids decode to, made where they are. Input columns
    named like the new ones give way; repeated rows repeat, an empty table
    gives no rows. ``model_file`` is opened on the executors; None is the
    installed 32k model. A worker's memory follows its longest text.
    """
    new = {"n_tokens": "n_tokens", "ids": "ids"} | ({decoded: "text"} if decoded else {})
    found, = free_name(docs, "encoded")
    out = docs.withColumn(found, _encoder(model_file, begin, end, decoded is not None)(F.col(f"`{text}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in new}],
                      *[F.col(f"{found}.{field}").alias(name) for name, field in new.items()])


def decode(encoded: DataFrame, ids: str = "ids", into: str = "decoded", model_file: str | None = None) -> DataFrame:
    """``encoded`` with the text that the library decodes ``ids`` to (null ids: null)."""
    return encoded.withColumn(into, _decoder(model_file)(F.col(f"`{ids}`")))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, and digests of its ids and of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, decoded="decoded").select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
