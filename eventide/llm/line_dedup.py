"""Line dedup with levelled sorted runs of line hashes.

``LineRuns`` remembers in how many documents each line has been seen, as a
log-structured store in the shared folder: every batch of documents adds one
run at level 0, a run being a table of (line hash, documents) bucketed and
sorted by hash; when a level has ``fanout`` runs they are compacted into one
run of the next level. Hashes that have reached the limit are decided: they
move to the decided run at compaction, and a new batch is merge-anti-joined
with it, so a line that fills the corpus is not counted for ever.

A batch is hashed once, to (document, line number, hash); texts are read again
only to write the lines that stay. Everything is a built-in expression.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import BLANKS, LOWER, UPPER, free_name, lower_ascii, saved, scratch, table

#: Documents from which on a line is dropped everywhere.
MIN_DOCS = 10
#: Runs of a level that are compacted into one of the next.
FANOUT = 4
#: Batches in which the registered query adds the documents.
BATCHES = 6


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def line_hash(key: Column) -> Column:
    """First 16 bytes of the SHA-256 of a key."""
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


def lines_of(text: Column) -> Column:
    """The lines of a whole text; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """In how many documents each line hash was seen, over all batches added.

    Runs have as many buckets as a shuffle has partitions when the store is
    made: a task writes one file, and a batch's counts, which one shuffle has
    brought together by hash, are merge-joined with the decided run as it lies.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.decided: str | None = None
        self.paths: dict[str, str] = {}

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch(self.spark, "run")
        (counts.select("h", "docs").repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h")
         .option("path", self.paths[name]).saveAsTable(name))
        return name

    def _files(self, name: str) -> DataFrame:
        """A run's rows without its buckets. Spark 4.1 takes a union of bucketed tables for one
        bucketed table and then groups it without a shuffle, which splits keys."""
        return self.spark.read.schema("h binary, docs long").parquet(self.paths[name])

    def _drop(self, names: list[str]) -> None:
        for name in names:  # the files stay in the shared folder: a lazy plan may still read them
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _summed(self, names: list[str]) -> DataFrame:
        frame = self._files(names[0])
        for name in names[1:]:
            frame = frame.unionByName(self._files(name))
        return frame.groupBy("h").agg(F.sum("docs").alias("docs"))

    def add(self, hashes: DataFrame) -> None:
        """Add a batch: one row (``h``) per distinct line of each document."""
        counts = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("docs"))
        if self.decided:
            # an anti join, written as an outer join: Spark would push the former below the counting,
            # and a hot line's rows would travel one by one to be dropped
            decided = self.spark.table(self.decided).select("h", F.lit(True).alias("known"))
            counts = counts.join(decided.hint("merge"), "h", "left").where("known is null")
        self.levels[0].append(self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        """Merge a level's runs into one of the next level; what reached the limit alone is decided."""
        if len(self.levels) == level + 1:
            self.levels.append([])
        runs = self.levels[level]
        merged = saved(self._summed(runs), "merged")
        over = merged.where(F.col("docs") >= self.min_docs)
        if self.decided:
            over = over.unionByName(self._files(self.decided)).dropDuplicates(["h"])
        before, self.decided = self.decided, self._write(over)
        self.levels[level + 1].append(self._write(merged.where(F.col("docs") < self.min_docs)))
        self.levels[level] = []
        self._drop([*runs, *([before] if before else [])])

    def forget(self) -> None:
        """Take the runs out of the session's catalog."""
        self._drop([name for level in self.levels for name in level] + ([self.decided] if self.decided else []))

    def common(self) -> DataFrame:
        """Distinct hashes (``h``) of the lines found in at least ``min_docs`` documents so far."""
        runs = [name for level in self.levels for name in level]
        found = self._summed(runs).where(F.col("docs") >= self.min_docs).select("h") if runs else None
        decided = self._files(self.decided).select("h") if self.decided else None
        if decided is None:
            return found
        return decided if found is None else decided.unionByName(found).distinct()


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``n_lines``, ``n_dropped`` (long).

    Lines whose key (see :func:`line_key`) is not empty and is found in at least
    ``min_docs`` documents are dropped from every document, the first one
    included; the others stay, joined by a line feed. A document is a row: a
    repeated row counts again, also with a null or repeated ``key``. A null text
    is one empty line and becomes an empty text. The other columns stay; input
    columns named like the two new ones give way. An empty table gives no rows.

    Rows that share the key are told apart by a hash of their text: what a row
    loses depends on its text alone.
    """
    spark = docs.sparkSession
    print_, = free_name(docs, "fingerprint")
    mark = F.xxhash64(F.col(f"`{text}`"))
    # line hashes of every row, once; rows alike share them
    hashed = saved(docs.select(
        F.col(f"`{key}`").alias("k"), mark.alias("p"),
        F.transform(lines_of(F.col(f"`{text}`")), line_key).alias("keys"),
    ).select("k", "p", F.pmod(F.xxhash64("k", "p"), F.lit(batches)).cast("int").alias("batch"),
             F.transform("keys", lambda x: F.when(x != "", line_hash(x))).alias("hashes")), "hashes")
    runs = LineRuns(spark, min_docs, fanout)
    for batch in range(batches):
        own = hashed.where(F.col("batch") == batch)
        runs.add(own.select(F.explode(F.array_distinct("hashes")).alias("h")).where("h is not null"))
    # a table of its own, so that both sides of the next join come from a shuffle: a hot line's rows are split, or it is broadcast
    common = saved(runs.common(), "common")
    runs.forget()
    # so is what is lost: it is broadcast where that is small, and no text is shuffled
    lost = saved(hashed.dropDuplicates(["k", "p"]).select("k", "p", F.posexplode("hashes").alias("at", "h")).where(
        "h is not null").join(common, "h", "left_semi").groupBy("k", "p").agg(
        F.array_sort(F.collect_list("at")).alias("lost")), "lost")
    return _kept(docs, key, text, mark, print_, lost)


def _kept(docs: DataFrame, key: str, text: str, mark: Column, print_: str, lost: DataFrame) -> DataFrame:
    """``docs`` without the lines at the places ``lost``: the stretches between them, in linear time."""
    lines, gone, there, same = free_name(docs, "lines", "lost", "k", "p")
    lost = lost.select(F.col("k").alias(there), F.col("p").alias(same), F.col("lost").alias(gone))
    marked = docs.withColumn(print_, mark)
    joined = marked.join(lost, marked[key].eqNullSafe(lost[there]) & (marked[print_] == lost[same]), "left")
    split = joined.withColumn(lines, lines_of(F.col(f"`{text}`"))).withColumn(
        gone, F.coalesce(gone, F.array().cast("array<int>")))
    total = F.size(lines)
    starts = F.concat(F.array(F.lit(-1)), F.col(gone))
    ends = F.concat(F.col(gone), F.array(total))
    stretches = F.zip_with(starts, ends, lambda a, b: F.slice(F.col(lines), a + 2, b - a - 1))
    rest = F.when(F.size(gone) == 0, F.coalesce(F.col(f"`{text}`"), F.lit(""))).otherwise(
        F.array_join(F.flatten(stretches), "\n"))
    return split.select(
        *[rest.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")],
        total.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))


def rewrite(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars",
            min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with their lines deduplicated and the columns they had.

    A column ``chars`` gets the new length of a text that lost lines; documents
    that lose all their lines stay, with an empty text.
    """
    out = dedup_lines(docs, key, text, min_docs)
    length = F.when(F.col("n_dropped") > 0, F.length(F.col(f"`{text}`")))
    kinds = dict(docs.dtypes)
    return out.select(*[F.coalesce(length.cast(kinds[c]), F.col(f"`{c}`")).alias(c) if c == chars else F.col(f"`{c}`")
                        for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, how many of them were dropped, and a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: DuckDB form of the query.
OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, row, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM lines
), common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT row) >= {MIN_DOCS}
)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id, row
"""
