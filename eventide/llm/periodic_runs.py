"""Periodic runs of words, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) that no neighbouring word extends keeping that period.

The words of a text are appended to a suffix automaton one by one. Each state
knows where its words last ended. Appending a word at ``i`` makes ``i`` the
last end of all suffixes of the text so far, that is of the whole path from the
newest state to the root of the suffix links. The paths are kept as those of a
link-cut tree: states with the same last end that lie on one path form a splay
tree, and *access* of the newest state walks up over them, cutting off what
hangs below. For a segment whose last end was ``e`` and which covers suffix
lengths ``(low, high]`` the distance ``d = i - e`` is a square if ``low < d <=
high``: the last ``d`` words ended at ``e`` too, and nowhere between, so their
repetition ends here and ``d`` is its smallest period. The other way round,
every square with smallest period ``d`` that ends at ``i`` shows up so. A square
outside the runs known for its period is extended in both directions to its
run, once. Amortised, an append meets O(log n) segments.

A run with at least four periods repeats each of its three-word sequences at
least three times, so the automaton need not see words that lie in no such
sequence: texts are first cut there (in numpy, again inside each stretch until
nothing changes). This leaves out no run that is asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import BLANKS, free_name, table

#: Words that a run has at least.
MIN_LENGTH = 6
#: Periods that a run has at least. Below four the cut of :func:`stretches` would not hold.
MIN_PERIODS = 4

#: Occurrences of each three-word sequence of such a run.
TIMES = 3

#: Fixed odd numbers that mix three word numbers into a key; equal keys of unlike words only keep more words.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class Squares:
    """Suffix automaton of the words appended so far; its suffix links as a link-cut tree.

    State 0 is the root and lies in no splay tree. ``left`` is towards the root
    of the links, ``right`` away from it. ``up`` is the parent in a splay tree,
    or, for its topmost node, the state that the path hangs from. ``end`` is
    right for topmost nodes: the last end of the whole path.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [0]
        self.left, self.right, self.up, self.end = [0], [0], [0], [-1]
        self.newest, self.words = 0, 0

    def _state(self, follow: dict[int, int], length: int, link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.left.append(0)
        self.right.append(0)
        self.up.append(link)
        self.end.append(-1)
        return len(self.length) - 1

    def _splay(self, x: int) -> None:
        """Make ``x`` the topmost node of its splay tree."""
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if left[p] != x and right[p] != x:
                return
            g = up[p]
            if left[g] == p:
                self._rotate(p if left[p] == x else x)
            elif right[g] == p:
                self._rotate(p if right[p] == x else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x
        else:  # p was topmost
            self.end[x] = self.end[p]
        up[p], up[x] = x, g

    def _clone(self, q: int, p: int, word: int) -> int:
        """A state for the shorter words of ``q``, between ``q`` and its link, on the path of ``q``."""
        self._splay(q)
        hung = self.up[q]
        clone = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = clone
        above = self.left[q]
        self.left[clone], self.up[clone], self.left[q] = above, q, clone
        if above:
            self.up[above] = clone
        self.up[q] = hung
        follow = self.next
        while True:
            if follow[p].get(word) != q:
                break
            follow[p][word] = clone
            if not p:
                break
            p = self.link[p]
        return clone

    def append(self, word: int) -> list[int]:
        """Add a word; the smallest periods of the squares that end with it."""
        i = self.words
        self.words += 1
        follow, length, link = self.next, self.length, self.link
        last = self.newest
        # suffixes that the word never followed, and the state that the longest other one leads to
        p, to = last, 0
        new = len(length)
        while word not in follow[p]:
            follow[p][word] = new
            if not p:
                p = -1
                break
            p = link[p]
        self._state({}, i + 1, 0)
        if p >= 0:
            to = follow[p][word]
            if length[p] + 1 != length[to]:
                to = self._clone(to, p, word)
        link[new] = self.up[new] = to
        self.newest = new
        return self._access(new, i)

    def _access(self, new: int, i: int) -> list[int]:
        """Put the path from ``new`` to the root into one splay tree; the squares on the way."""
        left, right, up, length, end = self.left, self.right, self.up, self.length, self.end
        periods = []
        below, x = new, up[new]
        while x:
            self._splay(x)
            e, high, hung = end[x], length[x], up[x]
            d = i - e
            if length[hung] < d <= high:
                periods.append(d)
            cut = right[x]
            if cut:
                end[cut] = e
            right[x] = below
            below, x = x, hung
        # the segments found stand one in the other: the whole is one path, ended at i
        end[below] = i
        self._splay(new)
        return periods


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``[a, b)`` outside which no run of at least ``MIN_PERIODS`` periods has a word."""
    at = np.arange(len(words) - 2)
    first = words.astype(np.uint64)
    keys = first[:-2] * MIX[0] + first[1:-1] * MIX[1] + first[2:] * MIX[2]
    part = np.zeros(len(at), np.uint64)
    while len(at) >= MIN_LENGTH - 2:
        mixed = keys[at] ^ (part * MIX[1])
        ranked = np.sort(mixed)
        repeated = ranked[:1 - TIMES][ranked[TIMES - 1:] == ranked[:1 - TIMES]]
        if not len(repeated):
            return []
        often = repeated[np.minimum(np.searchsorted(repeated, mixed), len(repeated) - 1)] == mixed
        whole = often.all()
        at, part = at[often], part[often]
        # neighbours that both stay, and were together before, stay together
        starts = np.concatenate([[True], (np.diff(at) != 1) | (part[1:] != part[:-1])])
        sizes = np.diff(np.flatnonzero(starts), append=len(at))
        enough = np.repeat(sizes >= MIN_LENGTH - 2, sizes)
        part = (np.cumsum(starts) - 1).astype(np.uint64)
        if whole and enough.all():
            heads = np.flatnonzero(starts)
            return [(int(a), int(b) + 3) for a, b in zip(at[heads], at[heads + sizes - 1], strict=True)]
        at, part = at[enough], part[enough]
    return []


def runs_in(words: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence with at least so many words and periods."""
    n, found, known = len(words), [], {}
    automaton = Squares()
    for i, word in enumerate(words):
        for d in automaton.append(word):
            if known.get(d, -1) >= i:
                continue
            a, b = i - 2 * d + 1, i + 1
            while a > 0 and words[a - 1] == words[a - 1 + d]:
                a -= 1
            while b < n and words[b] == words[b - d]:
                b += 1
            known[d] = b - 1
            if b - a >= max(min_length, min_periods * d):
                found.append((a, b - a, d))
    return found


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs of a text's words by start, then period."""
    if len(words) < MIN_LENGTH:
        return []
    number: dict[bytes, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(words) - len(number) < MIN_LENGTH - 2:
        return []
    found = []
    for a, b in stretches(numbers):
        found += [(a + s, length, q) for s, length, q in runs_in(numbers[a:b].tolist())]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _finder():
    @F.arrow_udf("struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def find(texts: pa.Array) -> pa.Array:
        sizes, ends, spans, kept = [], [0], [], []
        for text in texts:
            words = (text.as_py() or "").encode().split()
            runs = runs_of(words)
            sizes.append(len(words))
            spans += runs
            ends.append(len(spans))
            kept.append(b" ".join(collapsed(words, runs)))
        columns = [pa.array([s[k] for s in spans], pa.int64()) for k in range(3)]
        runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(RUN)))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_words", "runs", "collapsed"])

    return find


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are what ``[\\x20\\x09-\\x0D]`` separates, numbered from 0. ``runs``
    holds every run with at least ``MIN_LENGTH`` words and ``MIN_PERIODS``
    periods as (start, length, period), by start, then period. ``collapsed`` is
    the text's words without those that a run holds after its first period,
    joined by one space. A null or empty text has no words, no runs and an
    empty ``collapsed``. Rows are independent: repeated rows repeat, an empty
    table gives no rows. Input columns named like the new ones give way. A
    worker's memory follows the longest repetitive stretch of one text.
    """
    new = ("n_words", "runs", "collapsed")
    found, = free_name(docs, "found")
    out = docs.withColumn(found, _finder()(F.col(f"`{text}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new],
                      *[F.col(f"{found}.{c}") for c in new])


def longest(runs: Column) -> Column:
    """The greatest of the runs by length; of equal ones the first, then that with the smallest period. Null if none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct(
        (-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every tenth text, by the CRC-32 of its key, made periodic from some word on.

    With h the CRC-32 of the decimal key, g = h div 10 and n words, texts with
    10 | h have from word a = g mod n on the words a, ..., a + p - 1 over and
    over, p = 1 + (n - a) div (3 + g mod 8). Texts with a null key, no words or
    another h stay.
    """
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.split(F.btrim(F.col(f"`{text}`"), F.lit(BLANKS)), "[ \\t-\\r]+", -1)
    number, at, found = free_name(docs, "number", "at", "found")
    chosen = (F.pmod(h, F.lit(10)) == 0) & (F.btrim(F.col(f"`{text}`"), F.lit(BLANKS)) != "")
    out = docs.withColumn(found, F.when(chosen, words)).withColumn(number, g.cast("long"))
    n = F.size(found)
    out = out.withColumn(at, F.pmod(F.col(number), n.cast("long")).cast("int"))
    a = F.col(at)
    p = (1 + F.floor((n - a) / (3 + F.pmod(F.col(number), F.lit(8))))).cast("int")
    block = F.slice(found, a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    made = F.concat(F.slice(found, F.lit(1), a), F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), n - a))
    return out.select(*[F.when(F.col(found).isNotNull(), F.array_join(made, " ")).otherwise(F.col(f"`{c}`")).alias(c)
                        if c == text else F.col(f"`{c}`") for c in docs.columns])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs after the planting, the greatest one, and digests of all and of the collapsed text."""
    docs = planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = longest(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return find_runs(docs).select("doc_id", "n_words", "runs", "collapsed", best.alias("best")).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
