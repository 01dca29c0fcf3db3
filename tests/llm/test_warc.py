from __future__ import annotations

import gzip
import hashlib
import os
import random
from pathlib import Path

import pytest

from eventide.llm import warc


def brute(pages):
    """Expected rows: the smallest id of a payload of 100 bytes or more is the response."""
    first = {}
    for page_id, _, html in pages:
        body = (html or "").encode()
        if page_id is not None and len(body) >= 100:
            first[body] = min(page_id, first.get(body, page_id))
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        again = body in first and page_id != first[body]
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(map(str, out))


ODD = [(0, "http://a", None), (1, None, ""), (2, "u", "x" * 99), (3, "u", "x" * 99), (4, "u\r\nX: y", "é" * 50), (9, "u", "é" * 50),
       (5, "u", "é" * 50), (5, "u", "é" * 50), (None, "u", "é" * 50), (None, None, "z"), (7, "u", "a\r\n\r\nb" * 40), (8, "u", "\x00\x1f\x08" * 99),
       (-3, "u", "big" * 400_000)]


def check(spark, pages, path, schema="page_id long, url string, html string"):
    warc.write_archives(spark.createDataFrame(pages, schema).repartition(2), path)
    records = warc.read_archives(spark, path)
    assert sorted(str(tuple(r)) for r in warc.payloads(records).collect()) == brute(pages)
    return records


def test_edge_rows(spark, tmp_path):
    records = check(spark, ODD, f"{tmp_path}/w")
    got = {r.page_id: r for r in records.collect() if r.page_id is not None}
    assert got[4].url == "u%0D%0AX: y" and got[1].url is None and bytes(got[7].payload) == b"a\r\n\r\nb" * 40
    for part in Path(tmp_path, "w").glob("part-*"):  # any gzip tool reads the files
        assert gzip.decompress(part.read_bytes()).count(b"WARC/1.1\r\nWARC-Type") >= 1


def test_pages_that_share_an_id_but_not_the_payload(spark, tmp_path):
    pages = [(1, "u", "A" * 200), (1, "u", "B" * 300), (2, "u", "A" * 200), (1, "v", "A" * 200), (3, "u", "B" * 300), (2, "u", "B" * 300)]
    check(spark, pages, f"{tmp_path}/w")
    read = warc.payloads(warc.read_archives(spark, f"{tmp_path}/w", payloads=False))
    assert sorted(str(tuple(r)) for r in read.collect()) == brute(pages)


FOREIGN = [
    (b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 9\r\n\r\nsoftware:\r\n\r\n",
     ("warcinfo", "<urn:uuid:1>", None, None, b"software:", None)),
    (b"WARC/1.1\r\nwarc-type:response\r\nWARC-Record-ID:<urn:uuid:2>\r\nWARC-Target-URI:http://a/\r\n"
     b"Content-Type: application/http; msgtype=response\r\nContent-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\x00!!\r\n\r\n",
     ("response", "<urn:uuid:2>", None, "http://a/", b"body\x00", None)),
    (b"WARC/1.0\nWARC-Type: resource\nWARC-Payload-Digest: sha1:ABC\nX-Long: one\n  two\nContent-Length: 3\n\nabc\n\n",
     ("resource", None, None, None, b"abc", "sha1:ABC")),
    (b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Refers-To: <urn:uuid:2>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
     ("revisit", None, "<urn:uuid:2>", None, None, None)),
    (b"WARC/1.1\r\nNo colon\r\nContent-Type: text/plain\r\n\r\nno length\r\n\r\n", (None, None, None, None, b"no length", None)),
]


@pytest.mark.parametrize(("name", "size"), [("a.warc", "61"), ("a.warc", "100000"), ("a.warc.gz", "61"), ("b.xz", "200")])
def test_archives_of_other_writers(spark, tmp_path, name, size):
    """Other record types, ids, header styles and names; nothing is lost."""
    Path(tmp_path, name).write_bytes(b"".join(gzip.compress(raw, mtime=k) for k, (raw, _) in enumerate(FOREIGN * 6)))
    Path(tmp_path, "empty.gz").write_bytes(b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = [(r.record_type, r.record_id, r.refers_to_id, r.url, r.payload and bytes(r.payload), r.digest)
               for r in warc.read_archives(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(str, got)) == sorted(str(want) for _, want in FOREIGN * 6)
    assert warc.payloads(warc.read_archives(spark, str(tmp_path), payloads=False)).count() == 12


def test_broken_gz_raises(spark, tmp_path):
    Path(tmp_path, "a.gz").write_bytes(gzip.compress(b"WARC/1.0\r\n\r\n")[:-3])
    with pytest.raises(Exception, match="no whole WARC record"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_small_ranges_cut_members(spark, tmp_path):
    """Ranges of a few hundred bytes: members span many of them, and each is owned by one."""
    rnd = random.Random(2)
    pages = [(i, f"u{i}", "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(0, 4000)))) for i in range(60)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        check(spark, pages, f"{tmp_path}/w")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", ["97", "411", "100000"])
def test_false_magic_inside_members(spark, tmp_path, size):
    """Stored (uncompressed) members full of the magic and of whole fake headers."""
    import zlib
    rnd = random.Random(4)
    inner = [warc.MAGIC * 30, gzip.compress(b"not a record"), b"\x1f" + warc.MAGIC, os.urandom(50), warc.MAGIC + b"\x00" * 400]
    bodies = [b"".join(rnd.choice(inner) for _ in range(8)) for _ in range(12)]
    data = b""
    for i, body in enumerate(bodies):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        data += packer.compress(warc.record(i, "u", body, hashlib.sha256(body).hexdigest(), "response", None)) + packer.flush()
    Path(tmp_path, "a.warc").write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, f"{tmp_path}/a.warc").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(bodies))


def test_archive_inside_a_record(spark, tmp_path):
    import zlib
    inner = warc.member(warc.record(5, "i", b"inner" * 9, "d", "response", None)) * 3
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = packer.compress(warc.record(1, "u", inner, "d", "response", None)) + packer.flush()
    Path(tmp_path, "a.warc").write_bytes(outer * 2)
    assert [(r.page_id, bytes(r.payload)) for r in warc.read_archives(spark, f"{tmp_path}/a.warc").collect()] == [(1, inner)] * 2


@pytest.mark.parametrize("size", ["23", "150", "333", "100000"])
def test_magic_in_the_first_bytes_of_a_member(spark, tmp_path, size):
    """The bytes before the next magic are too few to decode: such a member is a record all the same."""
    rnd = random.Random(5)
    bodies = [bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randrange(20, 600))) for _ in range(30)]
    data = b""
    for i, body in enumerate(bodies):
        one = warc.member(warc.record(i, "u", body, hashlib.sha256(body).hexdigest(), "response", None))
        if i % 7 < 4:  # the magic as a time stamp: nothing before it can be decoded
            one = one[:4] + warc.MAGIC + one[7:]
        data += one + (warc.EMPTY_MEMBER if i % 5 == 0 else b"")
    Path(tmp_path, "a.warc").write_bytes(data)
    assert gzip.decompress(data).count(b"WARC/1.1") == 30
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = sorted((r.page_id, bytes(r.payload)) for r in warc.read_archives(spark, f"{tmp_path}/a.warc").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(enumerate(bodies))


def test_bytes_after_a_member_raise(spark, tmp_path):
    good = warc.member(warc.record(1, "u", b"abc" * 99, "d", "response", None))
    Path(tmp_path, "a.warc").write_bytes(good + b"rest")
    with pytest.raises(Exception, match="no whole WARC record"):
        warc.read_archives(spark, f"{tmp_path}/a.warc").collect()


def test_broken_archive_raises(spark, tmp_path):
    good = warc.member(warc.record(1, "u", b"abc" * 99, "d", "response", None))
    Path(tmp_path, "a.warc").write_bytes(good + good[:-9])
    with pytest.raises(Exception, match="no whole WARC record"):
        warc.read_archives(spark, f"{tmp_path}/a.warc").collect()


def test_empty_table_and_extra_columns(spark, tmp_path):
    schema = "page_id long, url string, html string, payload string, DIGEST int, first long"
    warc.write_archives(spark.createDataFrame([], schema), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0
    warc.write_archives(spark.createDataFrame([(1, "u", "h", "p", 2, 3)], schema), f"{tmp_path}/x")
    assert [bytes(r.payload) for r in warc.read_archives(spark, f"{tmp_path}/x").collect()] == [b"h"]


def test_query_matches_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert sorted(map(str, con.execute(warc.OP6_SQL).fetchall())) == sorted(str(tuple(r)) for r in warc.op6_warc(spark, sf).collect())
