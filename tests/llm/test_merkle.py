from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from eventide.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grow(level):
    """All levels over a list of digests, and per leaf the siblings on each (left, right)."""
    levels = [level]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + 3])) for i in range(0, len(now), 3)])
    sides = []
    for i in range(len(level)):
        own = []
        for now in levels[:-1]:
            first = i // 3 * 3
            own.append(("".join(now[first:i]), "".join(now[i + 1:first + 3])))
            i //= 3
        sides.append(own)
    return levels[-1][0], sides


def brute(rows):
    """The query's rows for documents (doc_id, source, lang, n_chars, text), in plain Python."""
    order = lambda v: (v is not None, v)
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append((order(r[0]), leaf(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        trees[name] = (sorted(sources[name]), *grow([x[1] for x in sorted(sources[name])]))
    root, upper = grow([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, upper, strict=True):
        leaves, subroot, sides = trees[name]
        for (_, digest, r), own in zip(leaves, sides, strict=True):
            path = own + above
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf((*r[:4], text))
            for left, right in path:
                h = sha(left + h + right)
            out.append((r[0], digest, subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, LEAF int, tree string, `path` string"


def table(spark, tmp_path, rows, parts=3):
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def rows_of(n, sources):
    text = ("a\nb", None, "", "\n", "é\n漢", "plain")
    return [(i, sources(i), ("en", None)[i % 5 == 0], (i, None)[i % 7 == 0], text[i % 6]) for i in range(n)]


@pytest.mark.parametrize("rows", [
    rows_of(1, lambda i: "s"),
    rows_of(400, lambda i: None if i % 3 == 0 else ("big", "", "é", "z", "=", "Z")[i % 40 % 6]),
    # repeated ids, repeated rows, null ids, negative ids, one-leaf sources
    rows_of(60, lambda i: f"s{i % 11}") + rows_of(20, lambda i: "s1") + rows_of(20, lambda i: "s1") + [
        (None, "s1", None, None, "a\n"), (None, "s1", None, None, "a\n"), (None, None, None, None, None), (-5, "s1", "x", 1, "\n")],
    rows_of(90, lambda i: f"lone {i}"),
])
def test_query_against_brute_force(spark, tmp_path, rows):
    got = sorted(map(tuple, merkle.op12_merkle(spark, table(spark, tmp_path, rows)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_bands_do_not_matter(spark, tmp_path, monkeypatch):
    rows = rows_of(120, lambda i: ("a", "b")[i % 10 == 0])
    monkeypatch.setattr(merkle, "BAND", 1)
    got = sorted(map(tuple, merkle.op12_merkle(spark, table(spark, tmp_path, rows)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_empty_table(spark, tmp_path):
    assert merkle.op12_merkle(spark, table(spark, tmp_path, [])).count() == 0


def test_nodes_are_nested_intervals(spark):
    rows = spark.range(200).select(F.lit("t").alias("tree"), F.col("id").alias("k"),
                                   F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    forest = merkle.plant_forest(rows, ["k"])
    nodes = sorted((r.level, r.lo, r.hi) for r in forest.nodes().collect())
    assert nodes == sorted((x, lo, min(lo + 3 ** x, 200)) for x in range(1, 6) for lo in range(0, 200, 3 ** x))
    assert [r.n for r in forest.roots().collect()] == [200]
    lined = forest.leaves.orderBy("lo").collect()
    assert [r.k for r in lined] == [r.lo for r in lined] == list(range(200))


def test_general_interface(spark):
    docs = spark.createDataFrame([("b", "x", 1), ("a", "x", 2), ("c", None, 3)], "name string, part string, v int")
    out = merkle.manifest(docs, key="name", tree="part", fields=("name", "v"), carry={"v2": F.col("v") * 2, "key": F.col("v"), "n": F.col("v"), "tree": F.col("part")})
    got = {r.name: r for r in out.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()}
    assert got["a"].leaf.hex() == leaf(("a", 2)) and got["c"].v2 == 6 and got["c"].key == got["c"].n == 3 and got["a"].tree == "x"
    sub = sha(leaf(("a", 2)) + leaf(("b", 1)))
    assert got["b"].subroot.hex() == sub and got["c"].subroot.hex() == leaf(("c", 3))
    assert all(r.root.hex() == sha(leaf(("c", 3)) + sub) == r.again.hex() for r in got.values())


def test_query_matches_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(merkle.OP12_SQL).fetchall())
    assert sorted(map(tuple, merkle.op12_merkle(spark, sf).collect())) == want and not all(r[-1] for r in want)
