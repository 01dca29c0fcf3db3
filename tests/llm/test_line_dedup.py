from __future__ import annotations

import random
from collections import Counter

import pytest

from eventide.llm import line_dedup as ld


def brute(texts, min_docs):
    fold = str.maketrans(ld.UPPER, ld.LOWER)
    key = lambda line: line.strip(ld.BLANKS).translate(fold)
    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    out = []
    for lines in split:
        stay = [x for x in lines if not (key(x) and seen[key(x)] >= min_docs)]
        out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


@pytest.mark.parametrize(("seed", "batches", "fanout", "min_docs"), [(1, 1, 4, 3), (2, 5, 2, 3), (3, 7, 3, 2), (4, 3, 2, 1)])
def test_against_brute_force(spark, seed, batches, fanout, min_docs):
    rnd = random.Random(seed)
    pool = ["a", " A\t", "b b", "É", "é", "", "  ", "c\x0b", "d\xa0", "x", "y" * 50] + [f"line {i}" for i in range(30)]
    texts = [None, "", "\n", "\n\na\n"] + ["\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12))) for _ in range(40)]
    keys = [None if i % 9 == 0 else i % 17 for i in range(len(texts))]  # nulls and repeats
    rows = list(zip(keys, texts, [7] * len(texts), strict=True))
    rows += rows[5:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_LINES int").repartition(3)
    out = ld.dedup_lines(docs, min_docs=min_docs, batches=batches, fanout=fanout)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    want = brute([r[1] for r in rows], min_docs)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((k, *w)) for (k, *_), w in zip(rows, want, strict=True))


@pytest.mark.parametrize("partitions", ["2", "4", "32"])
def test_runs_sum_over_batches_for_any_number_of_buckets(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        runs = ld.LineRuns(spark, min_docs=5, fanout=3)
        for _ in range(5):  # every hash once a batch, some in the last batches only
            runs.add(spark.range(300).selectExpr("unhex(substring(sha2(cast(id as string), 256), 1, 32)) h"))
        assert runs.common().count() == 300
        runs.add(spark.range(200, 400).selectExpr("unhex(substring(sha2(cast(id as string), 256), 1, 32)) h"))
        assert runs.common().count() == 300
        runs.forget()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(spark):
    assert ld.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_and_sql_count_rows_that_share_an_id(spark, tmp_path):
    import duckdb
    rows = [(7, "shared\nown a")] * 4 + [(7, "shared\nown b")] * 6 + [(None, "x\nnine")] * 9 + [(8, None), (8, None), (9, "nine")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = sorted(map(str, map(tuple, ld.op3_line_dedup(spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, con.execute(ld.OP3_SQL).fetchall()))
    assert sum(", 2, 1, " in r for r in got) == 19


def test_query_matches_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(ld.OP3_SQL).fetchall())
    assert sorted(map(tuple, ld.op3_line_dedup(spark, sf).collect())) == want and sum(r[2] for r in want) > 50
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]
