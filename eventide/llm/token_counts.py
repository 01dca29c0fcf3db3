"""Unigram token counts by dynamic programming over a trie of pre-tokens.

A text is cut into pre-tokens by the vocabulary's pattern. The best unigram
segmentation of a pre-token maximises the sum of its pieces' log
probabilities. Its forward score at a position depends only on the prefix that
ends there, so distinct pre-tokens go into a trie, each prefix is scored once
for all pre-tokens that share it, and the node where a pre-token ends stores
its token count. A document's count is the sum over its pre-tokens.

Each Python worker keeps one trie across batches and tasks. It is emptied when
it reaches ``MAX_NODES``, which bounds its memory and changes no result, so the
job has no shuffle and no state that grows with the corpus.
"""

from __future__ import annotations

import base64
import functools
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.bpe import chunks, default_ranks
from eventide.llm.common import free_name, table

#: Trie nodes a worker keeps at once.
MAX_NODES = 600_000
#: Bytes of a pre-token that go into the trie; what follows is scored in a sliding window.
MAX_DEPTH = 256
#: Log probabilities are whole multiples of this, so that equal sums are equal.
UNIT = 1e-6
#: Offset of Zipf's law (Mandelbrot's form), by which a rank stands for a probability.
ZIPF_OFFSET = 2.7


def zipf_scores(rank_file: str | None = None) -> dict[bytes, int]:
    """Log probabilities of a rank file's pieces, in units.

    A rank file orders its pieces by frequency and has no probabilities. Zipf's
    law gives them: p(rank) = 1 / ((rank + offset) * sum over all ranks of the same).
    A vocabulary with its own log probabilities takes their place as ``scores``.
    """
    with open(rank_file or default_ranks(), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    norm = math.log(sum(1 / (r + ZIPF_OFFSET) for r in ranks.values()))
    return {piece: round(-(math.log(r + ZIPF_OFFSET) + norm) / UNIT) for piece, r in ranks.items()}


class Terminals(dict):
    """Pre-token -> number of tokens, filled through the trie on first sight."""

    def __init__(self, scores: dict[bytes, int], max_nodes: int = MAX_NODES, max_depth: int = MAX_DEPTH):
        super().__init__()
        #: Every ending of a piece; its score if it is a piece itself. Looking back from a
        #: position stops at the first stretch that no piece ends with.
        self.endings: dict[bytes, int | None] = {}
        for piece, score in scores.items():
            for k in range(1, len(piece)):
                self.endings.setdefault(piece[k:], None)
            self.endings[piece] = score
        self.window = max(map(len, scores))
        self.max_nodes, self.max_depth = max_nodes, max_depth
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.child: dict[int, int] = {}
        self.score: list[int | None] = [0]
        self.tokens: list[int] = [0]

    def step(self, word: bytes, end: int, scores: list, tokens: list, first: int) -> tuple[int | None, int]:
        """Best score and fewest tokens of ``word[:end]``; the lists start at position ``first``."""
        best, fewest = None, 0
        start = end - 1
        while start >= 0:
            score = self.endings.get(word[start:end], False)
            if score is False:
                break
            if score is not None and (before := scores[start - first]) is not None:
                total, n = before + score, tokens[start - first] + 1
                if best is None or total > best or (total == best and n < fewest):
                    best, fewest = total, n
            start -= 1
        return best, fewest

    def __missing__(self, pretoken: str) -> int:
        tokens = self.best(pretoken)[1]
        if len(pretoken) <= self.max_depth:
            self[pretoken] = tokens
        return tokens

    def score_of(self, pretoken: str) -> int:
        """Log probability of the best segmentation, in units."""
        return self.best(pretoken)[0]

    def best(self, pretoken: str) -> tuple[int, int]:
        """Score and number of tokens of the best segmentation, by walking and growing the trie."""
        if len(self.score) > self.max_nodes:
            self.empty()
        word = pretoken.encode()
        node, scores, tokens = 0, [0], [0]
        for end in range(1, min(len(word), self.max_depth) + 1):
            edge = node << 8 | word[end - 1]
            node = self.child.get(edge)
            if node is None:
                best, fewest = self.step(word, end, scores, tokens, 0)
                node = self.child[edge] = len(self.score)
                self.score.append(best)
                self.tokens.append(fewest)
            scores.append(self.score[node])
            tokens.append(self.tokens[node])
        first = 0
        for end in range(self.max_depth + 1, len(word) + 1):
            best, fewest = self.step(word, end, scores, tokens, first)
            scores.append(best)
            tokens.append(fewest)
            if len(scores) > 8 * self.window + self.max_depth:
                first += len(scores) - self.window
                del scores[:-self.window], tokens[:-self.window]
        if scores[-1] is None:
            raise ValueError("the vocabulary has no pieces for some byte")
        return scores[-1], tokens[-1]


@functools.lru_cache(maxsize=2)
def worker(rank_file: str | None, pattern: str | None) -> tuple:
    """This worker's pattern and trie."""
    import public_tokenizers
    import regex

    return regex.compile(pattern or public_tokenizers.PATTERN), Terminals(zipf_scores(rank_file))


def count_text(text: str, find, terminals: Terminals) -> tuple[int, int]:
    """Numbers of pre-tokens and of tokens of a whole text."""
    pretokens = tokens = 0
    for part in chunks(text):
        found = find.findall(part)
        pretokens += len(found)
        tokens += sum(map(terminals.__getitem__, found))
    return pretokens, tokens


def _counter(rank_file: str | None, pattern: str | None):
    @F.arrow_udf("struct<n_pretokens:bigint,n_tokens:bigint>")
    def count(texts: pa.Array) -> pa.Array:
        find, terminals = worker(rank_file, pattern)
        found = [count_text(x.as_py() or "", find, terminals) for x in texts]
        return pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)],
                                          ["n_pretokens", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, text: str = "text", rank_file: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` (long) of each whole text.

    A null or empty text counts zero. Input columns with the new names (in any
    case) give way; rows are independent, so repeated rows repeat their counts.
    """
    new = ("n_pretokens", "n_tokens")
    found, = free_name(docs, "counted")
    out = docs.withColumn(found, _counter(rank_file, pattern)(F.col(f"`{text}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new],
                      *[F.col(f"{found}.{c}") for c in new])


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes, pre-tokens and unigram tokens."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(docs).select("doc_id", "n_bytes", "n_pretokens", "n_tokens")
