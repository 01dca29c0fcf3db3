"""Merkle manifest of a data set, with nested-interval labels.

Every row is a leaf; the leaves of a tree (a source) are ranked by key, and
every ``FANOUT`` consecutive nodes of a level have one parent, until one node is
left. A node is labelled with the interval ``[lo, hi)`` of the leaf ranks that
it covers, so

* an ancestor of a node is a node of a higher level whose interval contains the
  node's: ancestors are attached by containment joins, bucketed by level (at
  level l the candidates share ``lo div FANOUT^l``);
* the siblings of a node are the parts of its parent's interval beside its own:
  the interval difference, split into what lies to the left and to the right.

Levels are built and walked in bands of ``BAND``. All nodes of a band below one
of its top nodes are at most ``FANOUT^BAND`` leaves of that band and stand in
one shuffle partition, so a source that holds a third of all rows is spread
like any other. A band's results are tables in the shared folder; leaves are
ranked by a range sort, without gathering a source anywhere. The subroots are
the leaves of one more tree of the same kind.

Digests are SHA-256, hashed as lower-case hexadecimal text and kept as bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import saved, table

#: Children of a node.
FANOUT = 3
#: Levels that are built from one shuffle.
BAND = 4
#: Columns of a row that its leaf digest covers.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "struct<left:binary,right:binary>"


def hexed(digest: Column) -> Column:
    """Bytes as lower-case hexadecimal text."""
    return F.lower(F.hex(digest))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 (bytes) of the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _width(level: int) -> str:
    return f"{FANOUT ** level}L"


@dataclass
class Forest:
    """Trees by name.

    ``leaves``: the given rows with ``n`` (leaves of their tree) and ``lo``
    (rank), ``hi``. ``bands[k]``: one row per top node of the band that begins
    at level ``k * BAND``: tree, n, lo, hi, digest and ``below``, all nodes of
    the band under it with their children. A tree that ends inside a band has
    its root as top node. ``sizes``: tree, n.
    """

    leaves: DataFrame
    sizes: DataFrame
    bands: list[DataFrame]

    def roots(self) -> DataFrame:
        """Each tree's root: tree, n, digest."""
        out = None
        for k, band in enumerate(self.bands):
            ended = band.where(F.col("n") <= FANOUT ** ((k + 1) * BAND)).select("tree", "n", "digest")
            out = ended if out is None else out.unionByName(ended)
        return out

    def nodes(self) -> DataFrame:
        """All inner nodes: tree, level, lo, hi, digest."""
        out = None
        for band in self.bands:
            rows = band.select("tree", F.explode("below").alias("x")).select("tree", "x.level", "x.lo", "x.hi", "x.digest")
            out = rows if out is None else out.unionByName(rows)
        return out

    def paths(self, given: DataFrame) -> DataFrame:
        """The leaves with ``path`` (siblings on the way up, level by level, as bytes left and right).

        ``given`` has, per tree, a ``path`` that goes on from its root, and
        further columns, which its leaves get.
        """
        more = [c for c in given.columns if c not in ("tree", "path")]
        given = given.join(self.sizes, "tree")
        above = None
        for k in reversed(range(len(self.bands))):
            level = k * BAND
            top = FANOUT ** (level + BAND)
            if k:
                low = self.bands[k - 1].where(F.col("n") > FANOUT ** level).select("tree", "n", "lo", "hi")
            else:
                low = self.leaves
            ended = given.where((F.col("n") <= top) & (F.col("n") > (FANOUT ** level if k else 0))).select(
                "tree", F.lit(0).cast("long").alias("band"), F.col("path").alias("on"), *more)
            goes_on = ended if above is None else above.select(
                "tree", F.expr(f"lo div {top}L").alias("band"), F.col("path").alias("on"), *more).unionByName(ended)
            own = self._steps(low.select("tree", "n", "lo", "hi"), self.bands[k], level)
            met = low.join(own, ["tree", "lo"], "left").withColumn("band", F.expr(f"lo div {top}L")).join(
                goes_on, ["tree", "band"])
            path = F.concat(F.coalesce("steps", F.array().cast(f"array<{STEP}>")), "on")
            above = met.select(*low.columns, path.alias("path"), *more)
            if k:
                above = saved(above, "paths")
        return above

    @staticmethod
    def _steps(low: DataFrame, band: DataFrame, level: int) -> DataFrame:
        """The siblings that the nodes ``low`` of a level meet within the band above: tree, lo, ``steps``."""
        heights = F.array(*[F.struct(F.lit(x).alias("level"), F.lit(FANOUT ** x).cast("long").alias("width"))
                            for x in range(level + 1, level + BAND + 1)])
        wanted = low.select("tree", "n", "lo", "hi", F.explode(heights).alias("h")).where(
            F.col("n") > F.expr(f"h.width div {FANOUT}L")).select(
            "tree", "lo", "hi", F.col("h.level").alias("level"), F.expr("lo div h.width").alias("bucket"))
        parents = band.select("tree", F.explode("below").alias("x")).select(
            "tree", "x.level", F.expr(f"x.lo div cast(power({FANOUT}, x.level) as bigint)").alias("bucket"),
            F.col("x.lo").alias("from"), F.col("x.hi").alias("to"), "x.children")
        met = wanted.join(parents, ["tree", "level", "bucket"]).where("from <= lo and hi <= to")

        def digests(children: Column) -> Column:
            return F.aggregate(children, F.lit(b""), lambda acc, c: F.concat(acc, c["digest"]))

        left = digests(F.filter("children", lambda c: c["hi"] <= F.col("lo")))
        right = digests(F.filter("children", lambda c: c["lo"] >= F.col("hi")))
        steps = F.array_sort(F.collect_list(F.struct("level", left.alias("left"), right.alias("right"))))
        return met.groupBy("tree", "lo").agg(
            F.transform(steps, lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"))).alias("steps"))


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``n``, ``lo`` (rank in the tree by ``order``, nulls first) and ``hi``; and the sizes of the trees.

    Rows are sorted by range and numbered where they stand; a tree's rows in
    earlier partitions come from the counts per partition. Equal rows are told
    apart by a number, so that no group of them has to fit into one partition.
    """
    fixed = saved(rows.withColumn("seq", F.monotonically_increasing_id()), "rows")
    keys = ["tree", *order, "seq"]
    lined = saved(fixed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("seq")
                  .withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    parts = saved(lined.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
                  .select("tree", "part", "first",
                          (F.sum("rows").over(Window.partitionBy("tree").orderBy("part")) - F.col("rows")).alias("before"),
                          F.sum("rows").over(Window.partitionBy("tree")).alias("n")), "parts")
    out = lined.withColumn("part", part).join(parts, ["tree", "part"])
    lo = F.col("before") + F.col("at") - F.col("first")
    return (out.select(*rows.columns, "n", lo.alias("lo"), (lo + 1).alias("hi")),
            parts.groupBy("tree").agg(F.max("n").alias("n")))


def plant_forest(rows: DataFrame, order: list[str]) -> Forest:
    """Trees over ``rows`` (tree, digest, ...), leaves in the given order."""
    leaves, sizes = ranked(rows, order)
    leaves, sizes = saved(leaves, "leaves"), saved(sizes, "sizes")
    largest = sizes.agg(F.max("n")).first()[0] or 1  # one number
    bands, level = [], 0
    nodes = leaves.select("tree", "n", "lo", "hi", "digest")
    while not bands or FANOUT ** level < largest:
        bands.append(saved(_grown(nodes, level), "band"))
        level += BAND
        nodes = bands[-1].where(F.col("n") > FANOUT ** level).select("tree", "n", "lo", "hi", "digest")
    return Forest(leaves, sizes, bands)


def _grown(nodes: DataFrame, level: int) -> DataFrame:
    """The band over the nodes of a level, see :class:`Forest`."""
    child = "struct<lo:bigint,hi:bigint,digest:binary>"
    node = f"struct<level:int,lo:bigint,hi:bigint,digest:binary,children:array<{child}>>"
    rows = nodes.withColumn("band", F.expr(f"lo div {_width(level + BAND)}")).repartition("tree", "band").withColumn(
        "below", F.array().cast(f"array<{node}>"))
    for x in range(level, level + BAND):
        # the partitioning by (tree, band) holds for these keys too: no shuffle
        grouped = rows.groupBy("tree", "n", "band", F.expr(f"lo div {_width(x + 1)}").alias("at")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"),
            F.flatten(F.collect_list("below")).alias("below"))
        several = F.col("n") > FANOUT ** x
        joined = F.array_join(F.transform("children", lambda c: hexed(c["digest"])), "")
        made = grouped.select(
            "tree", "n", "band", "children", "below", several.alias("several"),
            F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            F.when(several, F.unhex(F.sha2(joined, 256))).otherwise(F.col("children")[0]["digest"]).alias("digest"))
        own = F.struct(F.lit(x + 1).alias("level"), "lo", "hi", "digest", "children").cast(node)
        rows = made.select("tree", "n", "band", "lo", "hi", "digest",
                           F.when(F.col("several"), F.concat("below", F.array(own))).otherwise(F.col("below")).alias("below"))
    return rows.select("tree", "n", "lo", "hi", "digest", "below")


def manifest(docs: DataFrame, key: str = "doc_id", tree: str = "source", fields: tuple[str, ...] = FIELDS,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """Per row: key, ``leaf``, ``subroot``, ``root`` (bytes) and ``path``, besides the columns ``carry`` (of other names).

    ``path`` holds the siblings from the leaf to the root, per level the digests
    to the left and to the right, joined. Rows of a tree stand by key (nulls
    first), those of equal key by leaf digest; trees by name, the null one
    first. Null fields have a digest like any other, repeated rows are leaves
    each, columns beyond ``fields`` do not count, an empty table gives no rows.
    Fields may be large: they are read once, and only digests are moved.
    """
    own = {c.lower(): F.col(f"`{c}`") for c in docs.columns}
    name = own[tree.lower()].cast("string")
    carry = carry or {}
    rows = docs.select(
        own[key.lower()].alias("k"), F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("tree"),
        leaf_digest(*[own[f.lower()] for f in fields]).alias("digest"),
        *[c.alias(f"_{alias}") for alias, c in carry.items()])
    trees = plant_forest(rows, ["k", "digest"])
    subroots = trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    crown = plant_forest(subroots, ["name"])
    root = crown.roots().select("tree", F.col("digest").alias("root"), F.array().cast(f"array<{STEP}>").alias("path"))
    above = saved(crown.paths(root).select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "above")
    return trees.paths(above).select(
        F.col("k").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"_{alias}").alias(alias) for alias in carry])


def folded(leaf: Column, path: Column) -> Column:
    """The root (bytes) that a leaf and its siblings give."""
    return F.unhex(F.aggregate(path, hexed(leaf), lambda acc, s: F.sha2(F.concat(hexed(s["left"]), acc, hexed(s["right"])), 256)))


def proof_digest(path: Column) -> Column:
    """SHA-256 (hexadecimal) of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""), 256)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots, proof digest, and whether it stands after the tampering."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = leaf_digest(*[text if f == "text" else F.col(f) for f in FIELDS])
    out = manifest(docs, carry={"found": found}).withColumn("again", folded(F.col("found"), F.col("path")))
    return out.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        hexed(F.col("again")).alias("folded_root"), (F.col("again") == F.col("root")).alias("verified"))


_CRC = """list_reduce(list_concat([4294967295::BIGINT],
    list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substring(doc_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, j: xor(x >> 1, (x & 1) * 3988292384::BIGINT)))"""


def _sql_leaf(text: str) -> str:
    fields = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(fields)})"


#: DuckDB form of the query. (The CRC's last inversion turns the parity.)
OP12_SQL = f"""
WITH RECURSIVE digests AS (
  SELECT doc_id, source, {_sql_leaf('text')} AS leaf,
         {_sql_leaf(f"(CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 1 THEN replace(text, chr(10), '') ELSE text END)")} AS found
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM digests
), trees AS (
  SELECT source, 0 AS level, rank AS idx, count(*) OVER (PARTITION BY source) AS width, leaf AS h FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, (width + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM trees WHERE width > 1 GROUP BY source, level, idx // 3, width
), tops AS (
  SELECT source, level AS height, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank, count(*) OVER () AS width
  FROM trees WHERE width = 1
), crown AS (
  SELECT 0 AS level, rank AS idx, width, h FROM tops
  UNION ALL
  SELECT level + 1, idx // 3, (width + 2) // 3, sha256(string_agg(h, '' ORDER BY idx))
  FROM crown WHERE width > 1 GROUP BY level, idx // 3, width
), sides AS (
  SELECT a.source, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM trees a JOIN trees b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.width > 1 GROUP BY a.source, a.level, a.idx
), crown_sides AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS r
  FROM crown a JOIN crown b ON a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.width > 1 GROUP BY a.level, a.idx
), walk AS (
  SELECT source, rank AS leaf_rank, 0 AS level, rank AS idx, found AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT w.source, w.leaf_rank, w.level + 1, w.idx // 3, sha256(s.l || w.h || s.r), w.proof || s.l || s.r
  FROM walk w JOIN sides s ON w.source IS NOT DISTINCT FROM s.source AND w.level = s.level AND w.idx = s.idx
), crown_walk AS (
  SELECT w.source, w.leaf_rank, 0 AS level, t.rank AS idx, w.h, w.proof
  FROM walk w JOIN tops t ON w.source IS NOT DISTINCT FROM t.source AND w.level = t.height
  UNION ALL
  SELECT w.source, w.leaf_rank, w.level + 1, w.idx // 3, sha256(s.l || w.h || s.r), w.proof || s.l || s.r
  FROM crown_walk w JOIN crown_sides s ON w.level = s.level AND w.idx = s.idx
)
SELECT v.doc_id, v.leaf, t.h AS subroot, c.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = c.h AS verified
FROM leaves v JOIN tops t ON v.source IS NOT DISTINCT FROM t.source
JOIN crown c ON c.width = 1
JOIN crown_walk w ON w.source IS NOT DISTINCT FROM v.source AND w.leaf_rank = v.rank AND w.level = c.level
"""
