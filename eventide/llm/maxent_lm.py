"""Language-model scores by a hashed maximum-entropy model.

P(word | history) is a product along a class tree: P(class | history), then
P(child | node, history) from node to node down to the word. Every factor is a
maximum-entropy model, a softmax over summed weights, whose features are the last
word, the last two words, and a skip over the last word (at the root; below it the
last word, and for the first nodes the skip), each hashed into tables whose size
follows the training tokens. The most frequent words, as many as
``HEAD``, are leaves of the tree: in order of spelling, which puts forms and languages
together, the words of a node are cut into ``BRANCH`` children of like mass, so frequent
words have short ways. All others
share classes by the first letters; there the word itself is given by its training
count with absolute discounting, and the discounted mass belongs to words never seen.

Counting, training and scoring are separate passes over whole texts:

1. Words of the training documents are counted in a table in the shared folder.
2. The most frequent words are numbered and sent to every task. Texts become
   arrays of numbers, written once. Rarer words keep their text and are joined to
   their counts.
3. The training texts are dealt out to the rounds, so each is learnt from once. In its round each
   task takes gradient steps (AdaGrad, one step size per row) over its texts from the common
   weights; the results are averaged row by row, weighted by how often a partition met the
   row, in a two-level sum as wide as the root of the number of tasks.
4. Batches of documents are scored with numpy over the rows their features name.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import saved, table

#: Children of a node of the class tree; its levels below the root.
BRANCH, LEVELS = 16, 3
#: Words that are numbered at most, as many as the tree has leaves.
HEAD = BRANCH ** (LEVELS + 1)
#: Classes of all other words.
TAIL_CLASSES = 16
#: Rows of the smallest and the largest table of a hashed feature (the largest is sorted as 16-bit numbers, pairs have twice as many).
LEAST_ROWS, MOST_ROWS = 1 << 10, 1 << 15
#: Step size of each round; every round starts from the weights that the round before it averaged, with texts of its own.
RATES = (0.7, 0.35, 0.15)
#: Greatest weight: three of them and a bias stay within what a float's exponential holds.
MOST = 20.0
#: Tokens of a gradient step, and of a scored batch.
BATCH = 16_384
#: Training tokens that one task takes its steps over, about: what is averaged grows with the tokens, not with the files.
TRAINER_TOKENS = 4_000_000
#: The end of a text as a word: no word has a line feed.
END = b"\n"
CLASSES = BRANCH + TAIL_CLASSES
#: Number of the start of a text as a history word; tail classes are numbered before it.
START = HEAD + TAIL_CLASSES


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text (A-Z lower-cased), then its end."""
    return [*(text or "").encode().lower().split(), END]


def tail_class(word: bytes) -> int:
    """Class of a word that is not listed, by its first bytes."""
    return zlib.crc32(word[:2]) % TAIL_CLASSES


class Numbers(dict):
    """Word -> number; a word without one gets that of its tail class."""

    def __missing__(self, word: bytes) -> int:
        return HEAD + tail_class(word)


# --- the model -----------------------------------------------------------------------------

def rows_for(tokens: int) -> int:
    """Rows of a table: in proportion to the cube root of the training tokens, as a power of two.

    A table travels once for every trainer, and trainers follow the tokens.
    """
    return min(MOST_ROWS, max(LEAST_ROWS, 1 << int(math.log2(max(tokens, 1)) / 3 + 5)))


@dataclass
class Vocabulary:
    """Numbered words by falling count, and what the counts say of all others."""

    words: list[bytes]
    counts: np.ndarray
    n: int
    v: int
    discount: float
    #: Training tokens and distinct words by tail class; numbered words are taken out at the start.
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def __post_init__(self) -> None:
        """Class of every number, and of the numbered words the way down the tree."""
        self.rows = rows_for(self.n)
        self.cls = np.concatenate([np.zeros(HEAD, np.int64), BRANCH + np.arange(TAIL_CLASSES), [0]])
        #: By level and number: the node that is left there, or -1 where the way has ended, and the child taken.
        self.node = np.full((LEVELS, START + 1), -1, np.int32)
        self.child = np.zeros((LEVELS, START + 1), np.int16)
        self.order = np.array(sorted(range(len(self.words)), key=self.words.__getitem__), np.int64)
        self.mass = np.concatenate([[0.0], np.cumsum(self.counts[self.order])])
        #: Log of each child's share of the training tokens, by node.
        self.bias: list[np.ndarray] = []
        self.class_mass = np.zeros(BRANCH)
        for k, (low, high) in enumerate(self._cut(0, len(self.words), BRANCH ** LEVELS)):
            self.cls[self.order[low:high]] = k
            self.class_mass[k] = self.mass[high] - self.mass[low]
            self._grow(low, high, 0)
        self.node_bias = np.array(self.bias, np.float32).reshape(-1, BRANCH)
        for word, count in zip(self.words, self.counts, strict=True):
            self.tail_tokens[tail_class(word)] -= count
            self.tail_words[tail_class(word)] -= 1
        hashed = np.arange(START + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        half = self.rows // 2
        self.row = np.where(np.arange(START + 1) < half - 1, np.arange(START + 1), half + hashed.astype(np.int64) % half)
        self.row[START] = half - 1
        self.log_base = self._log_base()

    def _cut(self, low: int, high: int, room: int) -> list[tuple[int, int]]:
        """The words ``[low, high)`` in at most ``BRANCH`` parts of like mass, none with more than ``room`` words."""
        parts = []
        for k in range(BRANCH):
            if low == high:
                break
            share = self.mass[low] + (self.mass[high] - self.mass[low]) / (BRANCH - k)
            end = int(np.searchsorted(self.mass, share, "right")) - 1
            end = min(max(end, low + 1, high - (BRANCH - k - 1) * room), low + room, high)
            parts.append((low, end))
            low = end
        return parts

    def _grow(self, low: int, high: int, level: int) -> None:
        """The nodes over the words ``[low, high)``; a single word is its own leaf."""
        if high - low < 2:
            return
        nr, bias = len(self.bias), np.full(BRANCH, -1e9)
        self.bias.append(bias)
        for k, (a, b) in enumerate(self._cut(low, high, BRANCH ** (LEVELS - 1 - level))):
            bias[k] = math.log((self.mass[b] - self.mass[a]) / (self.mass[high] - self.mass[low]))
            self.node[level, self.order[a:b]] = nr
            self.child[level, self.order[a:b]] = k
            self._grow(a, b, level + 1)

    def log_unseen(self) -> np.ndarray:
        """log10 of the mass of words never seen, by tail class."""
        mass = np.where(self.tail_tokens > 0, self.discount * self.tail_words / np.maximum(self.tail_tokens, 1), 1.0)
        return np.log10(mass)

    def _log_base(self) -> np.ndarray:
        """log10 base probability of the numbered words."""
        out = np.zeros(START + 1)
        out[:len(self.words)] = np.log10((self.counts + 0.5) / (self.n + 0.5 * (self.v + 1)))
        return out


def mixed(a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """Row of a pair of small numbers in a table of 2^k rows."""
    return ((a * 0x1F3D5B79 + b * 0x2545F491 + 0x3C6EF372) >> 7) * 0x27D4EB2F >> 11 & (rows - 1)


@dataclass
class Model:
    """Weights: ``by_class`` has the class factor's tables one below the other, ``by_node`` those of the other factors."""

    voc: Vocabulary
    by_class: np.ndarray
    by_node: np.ndarray
    class_bias: np.ndarray

    @classmethod
    def start(cls, voc: Vocabulary) -> Model:
        """No features yet: the biases give the training frequencies."""
        mass = np.concatenate([voc.class_mass, voc.tail_tokens + 0.5])
        mass[:BRANCH] = np.where(voc.class_mass > 0, voc.class_mass, 1e-30)
        return cls(voc, np.zeros((4 * voc.rows, CLASSES), np.float32), np.zeros((4 * voc.rows, BRANCH), np.float32),
                   np.log(mass / mass.sum()).astype(np.float32))

    def histories(self, texts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """All tokens of the texts, and for each the rows of its history's features."""
        gap = np.full(2, START, np.int32)
        whole = np.concatenate([x for t in texts for x in (gap, t)])
        own = np.concatenate([x for t in texts for x in (np.zeros(2, bool), np.ones(len(t), bool))])
        at = np.flatnonzero(own)
        row, size = self.voc.row[whole], self.voc.rows
        r1, r2 = row[at - 1], row[at - 2]
        return whole[at], [r1, r2 + size, mixed(r1, r2, 2 * size) + 2 * size]

    @staticmethod
    def sums(weights: np.ndarray, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
        """Summed weights; a feature with fewer rows is one of the first. Weights are at most ``MOST`` and biases logs of shares, so a float holds the exponentials."""
        logits = np.take(weights, rows[0], axis=0)
        for r in rows[1:]:
            logits[:len(r)] += np.take(weights, r, axis=0)
        logits += bias
        return logits

    @staticmethod
    def softmax(logits: np.ndarray) -> np.ndarray:
        """Shares of each row, in place."""
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    @staticmethod
    def log_share(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """log10 of the share of one column of each row."""
        own = logits[np.arange(len(logits)), chosen].astype(np.float64)
        np.exp(logits, out=logits)
        return (own - np.log(logits.sum(axis=1))) / math.log(10)

    def parts(self, ids: np.ndarray, rows: list[np.ndarray]):
        """Class and class sums of the tokens; for all nodes that they leave: the child taken, their positions, rows and sums."""
        size = self.voc.rows
        node = self.voc.node[:, ids]
        level, at = np.nonzero(node >= 0)
        left = node[level, at].astype(np.int64)
        # nodes of the first level, which come first, have the skip too
        first = int(np.searchsorted(level, 1))
        below = [mixed(left, rows[0][at], 2 * size), mixed(left[:first], rows[1][at[:first]] - size, 2 * size) + 2 * size]
        return (self.voc.cls[ids], self.sums(self.by_class, rows, self.class_bias), self.voc.child[level, ids[at]], at, below,
                self.sums(self.by_node, below, np.take(self.voc.node_bias, left, axis=0)))

    def log_probs(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 P of every token of the texts; of a word without a number, only of its class."""
        ids, rows = self.histories(texts)
        out = np.empty(len(ids))
        for low in range(0, len(ids), BATCH):
            part, own = ids[low:low + BATCH], [r[low:low + BATCH] for r in rows]
            cls, p, child, at, _, q = self.parts(part, own)
            out[low:low + BATCH] = self.log_share(p, cls) + np.bincount(at, self.log_share(q, child), len(part))
        return out


def group_sums(rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray, small: int = 16) -> np.ndarray:
    """Sums of consecutive rows, group by group: small groups all together, one place at a time; large ones each in a go."""
    order = np.argsort(-sizes, kind="stable")
    start, size = starts[order], sizes[order]
    sums = np.take(rows, start, axis=0)
    large = int(np.searchsorted(-size, -small, "left"))
    for k in range(1, small):
        upto = int(np.searchsorted(-size, -k, "left"))  # groups with more than k rows come first
        if upto <= large:
            break
        sums[large:upto] += np.take(rows, start[large:upto] + k, axis=0)
    for j in range(large):
        sums[j] = rows[start[j]:start[j] + size[j]].sum(axis=0)
    out = np.empty_like(sums)
    out[order] = sums
    return out


class Trainer:
    """One partition's gradient steps; ``met`` counts how often each row was a feature."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate = model, rate
        self.tables = [model.by_class.copy(), model.by_node.copy()]
        model.by_class, model.by_node = self.tables
        self.squares = [np.ones(len(t), np.float32) for t in self.tables]
        self.met = [np.zeros(len(t), np.float32) for t in self.tables]

    def update(self, which: int, rows: list[np.ndarray], gradient: np.ndarray) -> None:
        for r in rows:
            if not len(r):
                continue
            order = np.argsort((r - r.min()).astype(np.uint16), kind="stable")  # a table has at most 2^16 rows
            ranked = r[order]
            starts = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1])
            sizes = np.diff(starts, append=len(ranked))
            g = group_sums(np.take(gradient, order, axis=0), starts, sizes)
            own = ranked[starts]
            self.squares[which][own] += np.einsum("ij,ij->i", g, g)
            g *= (self.rate / np.sqrt(self.squares[which][own]))[:, None]
            self.tables[which][own] = np.clip(np.take(self.tables[which], own, axis=0) - g, -MOST, MOST)
            self.met[which][own] += sizes

    def learn(self, texts: list[np.ndarray]) -> None:
        ids, rows = self.model.histories(texts)
        for low in range(0, len(ids), BATCH):
            part, own = ids[low:low + BATCH], [r[low:low + BATCH] for r in rows]
            cls, p, child, at, below, q = self.model.parts(part, own)
            for which, own_rows, logits, taken in ((0, own, p, cls), (1, below, q, child)):
                if len(logits):
                    gradient = self.model.softmax(logits)
                    gradient[np.arange(len(gradient)), taken] -= 1
                    self.update(which, own_rows, gradient)


def batches_of(packed: Iterator[bytes], tokens: int = 4 * BATCH) -> Iterator[list[np.ndarray]]:
    """Texts' number arrays in lists of about ``tokens`` tokens; a longer text is a list of its own."""
    held, size = [], 0
    for data in packed:
        held.append(np.frombuffer(data, "<i4"))
        size += len(held[-1])
        if size >= tokens:
            yield held
            held, size = [], 0
    if held:
        yield held


# --- the passes ----------------------------------------------------------------------------

def is_held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 1 by 5; a null key is the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 1


def count_words(docs: DataFrame, text: str = "text", held: int = 300_000) -> DataFrame:
    """(word binary, c long): words and ends of all texts; a task hands on what it has at ``held`` distinct words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
            counts.clear()
            return batch

        for batch in batches:
            for t in batch.column(0):
                counts.update(words_of(t.as_py()))
                if len(counts) >= held:
                    yield out()
        if counts:
            yield out()

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(counted, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def count_step(c: str = "c") -> Column:
    """Steps of a count, sixteen for each doubling."""
    return F.floor(F.log2(c) * 16)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """What the driver keeps of the counts: the numbered words and sums; and the step from which on words
    are numbered, the lowest that at most ``HEAD`` words reach."""
    sums = counts.agg(F.sum("c"), F.count("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    n, v, once, twice = (x or 0 for x in sums)
    held, least = 0, 0
    steps = counts.groupBy(count_step().alias("step")).agg(F.count(F.lit(1)).alias("words"))
    for step, words in sorted(map(tuple, steps.collect()), reverse=True):  # at most 16 x 63 rows
        held += words
        if held > HEAD:
            least = step + 1
            break
    top = counts.where(count_step() >= least).orderBy(F.desc("c"), "word").toArrow()
    by_class = counts.groupBy((F.crc32(F.substring("word", 1, 2)) % TAIL_CLASSES).alias("k")).agg(F.sum("c"), F.count("c"))
    tokens, words = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for k, a, b in by_class.collect():
        tokens[k], words[k] = a, b
    return Vocabulary(top.column("word").to_pylist(), top.column("c").to_numpy().astype(np.float64), n, v,
                      once / (once + 2 * twice) if once and twice else 0.5, tokens, words), least


def encode(docs: DataFrame, voc: Vocabulary, key: str, text: str) -> DataFrame:
    """Texts as numbers, one row each: row, key, held_out, ids, and the words without a number with their frequencies."""
    shared = docs.sparkSession.sparkContext.broadcast(voc.words)
    kind = docs.schema[key].dataType.simpleString()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers((w, i) for i, w in enumerate(shared.value))
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                ids, rare, freq = [], [], []
                for t in part.column(2):
                    words = words_of(t.as_py())
                    own = np.fromiter(map(numbers.__getitem__, words), "<i4", len(words))
                    tail = Counter(words[k] for k in np.flatnonzero(own >= HEAD).tolist())
                    ids.append(own.tobytes())
                    rare.append(list(tail))
                    freq.append(list(tail.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + part.num_rows)), part.column(0), part.column(1), pa.array(ids, pa.binary()),
                     pa.array(rare, pa.list_(pa.binary())), pa.array(freq, pa.list_(pa.int32()))],
                    ["row", "key", "held_out", "ids", "rare", "freq"])
                row += part.num_rows

    source = docs.select(F.col(f"`{key}`").alias("key"), is_held_out(F.col(f"`{key}`")).alias("held_out"), F.col(f"`{text}`").alias("text"))
    return saved(source.mapInArrow(
        numbered, f"row long, key {kind}, held_out boolean, ids binary, rare array<binary>, freq array<int>"), "numbers")


#: Rows of the weight tables that travel together in the sum over partitions.
CHUNK_ROWS = 512


def train_round(encoded: DataFrame, model: Model, rate: float, nr: int = 0, rounds: int = 1) -> Model:
    """Gradient steps over the training texts of round ``nr`` of ``rounds``, averaged over the partitions."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        trainer = Trainer(Model(m.voc, m.by_class, m.by_node, m.class_bias), rate)
        seen = False
        for texts in batches_of(x.as_py() for batch in batches for x in batch.column(0)):
            trainer.learn(texts)
            seen = True
        for which, (weights, met) in enumerate(zip(trainer.tables, trainer.met, strict=True)) if seen else ():
            for low in range(0, len(weights), CHUNK_ROWS):
                own = met[low:low + CHUNK_ROWS]
                if not own.any():
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array([which * MOST_ROWS + low // CHUNK_ROWS], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                     pa.array([own.tobytes()], pa.binary()), pa.array([(weights[low:low + CHUNK_ROWS] * own[:, None]).tobytes()], pa.binary())],
                    ["chunk", "part", "met", "weights"])

    def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = weights = None
        for batch in batches:
            for a, b in zip(batch.column("met"), batch.column("weights"), strict=True):
                a, b = np.frombuffer(a.as_py(), np.float32), np.frombuffer(b.as_py(), np.float32)
                met, weights = (a.copy(), b.copy()) if met is None else (met + a, weights + b)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([met.tobytes()], pa.binary()),
             pa.array([weights.tobytes()], pa.binary())], ["chunk", "part", "met", "weights"])

    form = "chunk int, part int, met binary, weights binary"
    trainers = max(1, math.ceil(model.voc.n / rounds / TRAINER_TOKENS))
    own = F.pmod(F.xxhash64("row"), F.lit(rounds)) == nr
    texts = encoded.where(~F.col("held_out") & own).select("ids").coalesce(trainers)
    partial = texts.mapInArrow(learned, form)
    once = partial.groupBy("chunk", (F.col("part") % math.ceil(math.sqrt(trainers))).alias("group")).applyInArrow(summed, form)
    tables = [model.by_class.copy(), model.by_node.copy()]
    for r in once.groupBy("chunk").applyInArrow(summed, form).toLocalIterator():
        which, low = r.chunk // MOST_ROWS, r.chunk % MOST_ROWS * CHUNK_ROWS
        met = np.frombuffer(bytes(r.met), np.float32)
        weights = np.frombuffer(bytes(r.weights), np.float32).reshape(len(met), -1)
        own = tables[which][low:low + CHUNK_ROWS]
        own[met > 0] = weights[met > 0] / met[met > 0, None]
    shared.unpersist()
    return Model(model.voc, *tables, model.class_bias)


def score_numbers(encoded: DataFrame, model: Model) -> DataFrame:
    """Sums over the tokens of each text; of words without a number, only the class is in ``score``."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        base = m.voc.log_base
        for batch in batches:
            done = 0
            for texts in batches_of(x.as_py() for x in batch.column(3)):
                sizes = np.array([len(t) for t in texts])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                ids = np.concatenate(texts)
                own = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(k) for k in range(3)), pa.array(sizes.astype(np.int64)),
                     pa.array(np.add.reduceat((ids < HEAD).astype(np.int64), starts)),
                     pa.array(np.add.reduceat(base[ids], starts)), pa.array(np.add.reduceat(m.log_probs(texts), starts))],
                    ["row", "key", "held_out", "n_tokens", "known", "base", "score"])

    kind = encoded.schema["key"].dataType.simpleString()
    return encoded.select("row", "key", "held_out", "ids").mapInArrow(
        scored, f"row long, key {kind}, held_out boolean, n_tokens long, known long, base double, score double")


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", rates: tuple[float, ...] = RATES) -> DataFrame:
    """One row per document: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out (see :func:`is_held_out`)
    and scores all. A null or empty text is its end alone; repeated rows are
    scored each. Without training documents both scores of every text are 0. An
    empty table gives no rows.
    """
    train = docs.where(~is_held_out(F.col(f"`{key}`")))
    counts = saved(count_words(train, text), "counts")
    voc, least = vocabulary(counts)
    encoded = encode(docs, voc, key, text)
    model = Model.start(voc)
    for nr, rate in enumerate(rates if voc.n else ()):
        model = train_round(encoded, model, rate, nr, len(rates))

    # words without a number: their count decides base and place
    rare = encoded.select("row", F.inline(F.arrays_zip("rare", "freq"))).withColumnRenamed("rare", "word")
    place = F.crc32(F.substring("word", 1, 2)) % TAIL_CLASSES
    log_tokens = F.element_at(F.array(*[F.lit(math.log10(max(1.0, x))) for x in voc.tail_tokens]), (place + 1).cast("int"))
    unseen = F.element_at(F.array(*[F.lit(float(x)) for x in voc.log_unseen()]), (place + 1).cast("int"))
    seen = F.coalesce("c", F.lit(0))
    sums = rare.join(counts.where(count_step() < least), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("freq")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("freq") * F.log10((seen + 0.5) / F.lit(voc.n + 0.5 * (voc.v + 1)))).alias("rare_base"),
        F.sum(F.col("freq") * F.when(F.col("c") > 0, F.log10(F.col("c") - F.lit(voc.discount)) - log_tokens).otherwise(unseen)).alias("rare_score"))
    both = score_numbers(encoded, model).join(sums, "row", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias
    score = F.when(F.lit(voc.n > 0), F.col("score") + F.coalesce("rare_score", F.lit(0.0))).otherwise(0.0)
    return both.select(F.col("key").alias(key), "held_out", "n_tokens", plus("known", "rare_known")("n_known"),
                       F.lit(voc.n).cast("long").alias("train_tokens"), plus("base", "rare_base")("base_score"), score.alias("score"))


def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the model, beside the unigram base."""
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
