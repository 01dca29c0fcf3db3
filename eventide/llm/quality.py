"""Quality rules: document statistics, fixed limits, and boosted trees with monotonic constraints.

Statistics come from whole texts in one pass. Fixed limits reject a document
outright; the rest is judged by gradient-boosted trees over ratios of the
statistics, fitted on a bounded sample of labelled documents. A fitted model is
a few numpy arrays of nodes, which score a batch tree by tree, one level at a
time for all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import BLANKS, UPPER, free_name, table

#: Words that a repeated stretch has.
STRETCH = 5
#: Fixed limits: fewer words, or a larger share of words (in percent) in repeated stretches, fail.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Labelled documents that the trees are fitted on at most: those whose ids hash lowest.
SAMPLE_ROWS = 20_000
#: Probability of good quality from which a document is kept.
KEEP_FROM = 0.5

#: Statistics of a text, in order.
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_lines", "n_distinct", "n_upper", "n_digits", "n_stops", "n_wide"]
#: Features of the trees: ratios of the statistics, and how the score may change as one grows (0: either way).
FEATURES = {"log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
            "words_per_line": 0, "distinct_share": 0, "upper_share": 0, "digit_share": 0, "stop_share": 0, "wide_share": 0}


# --- statistics ----------------------------------------------------------------------------

def repeated_words(words: list, size: int = STRETCH, small: int = 50_000) -> int:
    """Words inside stretches of ``size`` words that the text has at least twice, the first one included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    if n <= small:
        stretches = list(zip(*(words[k:n + k] for k in range(size)), strict=True))
        counts = Counter(stretches)
        if len(counts) == n:
            return 0
        twice = np.fromiter((counts[s] > 1 for s in stretches), bool, n)
    else:  # stretches as numbers, each built from the number of a shorter one and of the word after it
        numbers: dict = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        codes = ids[:n]
        for k in range(1, size):
            _, codes = np.unique(codes * len(numbers) + ids[k:n + k], return_inverse=True)
        twice = np.bincount(codes)[codes] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + size, -1)
    return int((np.cumsum(covered) > 0).sum())


def _only(characters: str) -> bytes:
    """For ``translate``: every byte but these ASCII characters."""
    return bytes(c for c in range(256) if chr(c) not in characters)


NO_SYMBOL, NO_UPPER, NO_DIGIT, NO_STOP = map(_only, (SYMBOLS, UPPER, "0123456789", ".!?"))


def statistics(text: str | None) -> tuple[int, ...]:
    """The :data:`STATISTICS` of a whole text; null has none of anything."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    symbols, upper, digits, stops = (len(data.translate(None, rest)) for rest in (NO_SYMBOL, NO_UPPER, NO_DIGIT, NO_STOP))
    return (len(words), len(text) - sum(map(text.count, BLANKS)), symbols, len(lines) - len(set(lines)),
            repeated_words(words), len(lines), len(set(words)), upper, digits, stops, len(data) - len(text))


@F.arrow_udf(T.StructType([T.StructField(s, T.LongType()) for s in STATISTICS]))
def _statistics(texts: pa.Array) -> pa.Array:
    rows = np.array([statistics(t.as_py()) for t in texts], np.int64).reshape(-1, len(STATISTICS))
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(STATISTICS))], STATISTICS)


def features(stats: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` per row of statistics."""
    words, chars, symbols, dups, repeats, lines, distinct, upper, digits, stops, wide = stats.T.astype(np.float64)
    w, c, n = (np.maximum(x, 1) for x in (words, chars, lines))
    return np.stack([np.log1p(words), chars / w, symbols / w, dups / n, repeats / w, words / n, distinct / w,
                     upper / c, digits / c, stops / w, wide / c], axis=1)


# --- boosted trees -------------------------------------------------------------------------

@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf is its own child. ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class for every row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                down = x[rows, self.feature[node]] <= self.limit[node]
                node = np.where(down, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], n_trees: int = 40, depth: int = 4, rate: float = 0.2,
        bins: int = 48, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Gradient-boosted trees for the log loss, on binned features.

    ``signs`` has -1, 0 or 1 per feature. A split on a constrained feature must
    order its sides' values that way, and their midpoint then bounds all values
    below it, so the whole score is monotonic in the feature.
    """
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    coded = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], axis=1)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    start = math.log(share / (1 - share))
    nodes: list[list] = []  # feature, limit, left, right, value
    roots, total = [], np.full(len(x), start)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return min(max(-g / (h + ridge), low), high)

    def gain(g, h, v):
        return -(g * v + 0.5 * (h + ridge) * v * v)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        own = leaf(gs, hs, low, high)
        nodes.append([0, np.inf, at, at, own * rate])
        best = (1e-6, None)
        for f in range(x.shape[1]) if level < depth else ():
            if not len(edges[f]):
                continue
            gl = np.cumsum(np.bincount(coded[rows, f], g[rows], len(edges[f]) + 1))[:-1]
            hl = np.cumsum(np.bincount(coded[rows, f], h[rows], len(edges[f]) + 1))[:-1]
            vl = np.clip(-gl / (hl + ridge), low, high)
            vr = np.clip(-(gs - gl) / (hs - hl + ridge), low, high)
            won = gain(gl, hl, vl) + gain(gs - gl, hs - hl, vr) - gain(gs, hs, own)
            fine = (hl >= least) & (hs - hl >= least) & (signs[f] * (vr - vl) >= 0)
            if fine.any() and (k := int(np.argmax(np.where(fine, won, -np.inf)))) >= 0 and won[k] > best[0]:
                best = (won[k], (f, k, vl[k], vr[k]))
        if best[1]:
            f, k, vl, vr = best[1]
            middle = (vl + vr) / 2
            left, right = ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle)) if signs[f] < 0 else ((low, high),) * 2
            down = coded[rows, f] <= k
            nodes[at][:2] = [f, edges[f][k]]
            nodes[at][2] = grow(rows[down], g, h, level + 1, *left)
            nodes[at][3] = grow(rows[~down], g, h, level + 1, *right)
        return at

    every = np.arange(len(x))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(every, p - y, p * (1 - p), 0, -np.inf, np.inf))
        one = Trees(*(np.array([n[k] for n in nodes]) for k in range(5)), np.array(roots[-1:]), depth, 0.0)
        step = one.score(x)
        total = total + np.log(step / (1 - step))
    return Trees(*(np.array([n[k] for n in nodes]) for k in range(5)), np.array(roots), depth, start)


# --- the operator --------------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Trees | None:
    """Trees fitted on at most ``sample_rows`` labelled documents, or None where the labels have not both classes.

    The sample is a bounded number of labels, so it is broadcast to the documents
    and only their statistics come back. Null keys and labels are left out; of
    rows that share a key the smallest statistics count.
    """
    mark, = free_name(docs, "label")
    picked = labels.select(F.col(key).alias(key), F.col(label).cast("double").alias(mark)).dropna().groupBy(key).agg(
        F.min(mark).alias(mark)).orderBy(F.xxhash64(key), key).limit(sample_rows)
    known = docs.select(key, F.col(f"`{text}`").alias("text_")).join(F.broadcast(picked), key).select(
        key, mark, _statistics("text_").alias("s")).groupBy(key, mark).agg(F.min("s").alias("s"))
    rows = known.orderBy(key).select(mark, "s.*").toArrow()
    y = rows.column(mark).to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    x = features(np.stack([rows.column(s).to_numpy() for s in STATISTICS], axis=1))
    return fit(x, (y > 0).astype(float), list(FEATURES.values()))


def judge(docs: DataFrame, trees: Trees | None, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with the column ``quality_rules``: the statistics, ``base_failed``, ``score`` and ``kept``.

    A null or empty text has no words and fails the fixed limits. Without trees
    (no labels of both classes) every score is 1: the fixed limits alone decide.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.ones(len(stats)))
        columns = [stats.field(s).to_numpy(zero_copy_only=False) for s in STATISTICS]
        return pa.array(shared.value.score(features(np.stack(columns, axis=1))))

    found, points, result = free_name(docs, "stats", "score", "quality_rules")
    out = docs.withColumn(found, _statistics(F.col(f"`{text}`"))).withColumn(points, score(found))
    stat = F.col(found)
    failed = (stat.n_words < MIN_WORDS) | (100 * stat.n_repeat_words > MAX_REPEAT_PERCENT * stat.n_words)
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(*[stat[s].alias(s) for s in STATISTICS], failed.alias("base_failed"), F.col(points).alias("score"),
                 (~failed & (F.col(points) >= keep_from)).alias("kept")).alias(result))


def keep_good(docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """``docs`` without the documents that the rules reject; columns as they are."""
    judged = judge(docs, trees, text)
    verdict = judged.columns[-1]
    return judged.where(F.col(f"{verdict}.kept")).drop(verdict)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics and verdict, by trees fitted on ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = train(docs, table(spark, sf_dir, "labels"))
    return judge(docs, trees).select("doc_id", *[f"quality_rules.{s}" for s in STATISTICS[:5]],
                                     "quality_rules.base_failed", "quality_rules.kept", "quality_rules.score")
