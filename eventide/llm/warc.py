"""WARC archives: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own, so a reader can start at any member.
The writer hands Spark's text sink blocks of finished members, so files are
committed by Spark's own protocol to whatever store holds the folder; the
sink's line separator is an empty gzip member, which readers skip.

The reader lets Spark's text source cut the files into byte ranges with the
gzip magic as line separator: a task scans its range for the magic and owns
what starts inside. Such a candidate is a record only if its member header and
the first bytes it decodes to are right. The magic also turns up inside
compressed data, so bytes that start no record belong to the member before
them, or to one of their own that follows it (its first bytes hold the magic);
where that member began in an earlier range, both parts leave their tasks
as fragments and are joined by file and range. No file is read as a whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import saved, scratch, table

#: First bytes of every gzip member (deflate).
MAGIC = b"\x1f\x8b\x08"
#: The empty member between blocks: fixed value, a gzip member of no bytes.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
#: Payloads from this size on are written once; equal ones become revisits.
MIN_REVISIT_BYTES = 100
#: Compressed bytes that the writer puts between two separators, about.
BLOCK_BYTES = 1 << 20
#: Compressed bytes that the reader decodes at once.
PIECE_BYTES = 1 << 16
#: Time of the records: archives of equal pages are equal.
RECORD_DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


# --- records -------------------------------------------------------------------------------

def member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: an HTTP response, or a revisit that names the response with the same payload."""
    head = [f"WARC-Type: {kind}", f"WARC-Date: {RECORD_DATE}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    block = HTTP_HEAD
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a decoded record.

    Names count in any case, a value may go on in indented lines, lines may end
    in a line feed alone, and what is not stated is null. The payload is what
    follows the HTTP head in a block of HTTP, else the block; a revisit has
    none. Page ids are those of this module's writer; ids of others stay text.
    """
    cut = re.search(rb"\r?\n\r?\n", data)
    head, rest = (data[:cut.start()], data[cut.end():]) if cut else (data, b"")
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").splitlines()[1:]:
        if line[:1] in (" ", "\t"):
            fields[name] = f"{fields.get(name, '')} {line.strip()}"
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    size = fields.get("content-length", "")
    block = rest[:int(size)] if size.isdigit() else rest.removesuffix(b"\r\n\r\n")
    kind = fields.get("warc-type", "").lower() or None
    payload = None
    if kind != "revisit":
        http = re.search(rb"\r?\n\r?\n", block) if fields.get("content-type", "").lower().startswith("application/http") else None
        payload = block[http.end():] if http else block
    return {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": _page(fields.get("warc-refers-to")), "payload": payload,
            "digest": fields["warc-payload-digest"].removeprefix("sha256:") if "warc-payload-digest" in fields else None,
            "record_id": fields.get("warc-record-id"), "refers_to_id": fields.get("warc-refers-to"),
            "payload_bytes": None if payload is None else len(payload),
            "payload_digest": None if payload is None else hashlib.sha256(payload).hexdigest()}


def _page(record_id: str | None) -> int | None:
    """The page id in a record id of :func:`record`."""
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


# --- writing -------------------------------------------------------------------------------

def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every page.

    Of equal payloads of at least ``min_bytes`` bytes the smallest page_id is
    the response, and ``refers_to`` of the others names it. The smallest id of
    each digest that repeats is aggregated before the shuffle and written as a
    table, so its size is known: where that is small it is broadcast and no
    payload is shuffled; else pages meet by digest, and a digest with very many
    pages is split by Spark's skew join. Rows that repeat the smallest id are
    responses too; if no page of a payload has an id, all are.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = saved(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"), "firsts")
    known = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return known.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) below ``path``.

    A null html is an empty payload, a null page_id or url is left out of the
    record, other columns are not written, an empty table gives an archive
    without records. The files are multi-member gzip without a name ending, since
    Hadoop's readers do not split what is called .gz.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            for k in range(batch.num_rows):
                page, url, payload, digest, refers_to = (c[k].as_py() for c in columns)
                kind = "response" if refers_to is None else "revisit"
                held.append(member(record(page, url, payload, digest, kind, refers_to)))
                size += len(held[-1])
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["block"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["block"])

    rows = plan_records(pages, min_bytes).select("page_id", "url", "payload", "digest", "refers_to")
    rows.mapInArrow(blocks, "block binary").select(F.col("block").cast("string").alias("value")).write.option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


# --- reading -------------------------------------------------------------------------------

def starts_record(candidate: bytes) -> bool:
    """Whether bytes after a magic are the start of a WARC record's member, or of an empty member."""
    try:
        opened = zlib.decompressobj(31)
        head = opened.decompress(MAGIC + candidate[:4096], 64)
    except zlib.error:
        return False
    return head.startswith(b"WARC/") or (opened.eof and not head)


def decoded(data: bytes) -> list[bytes] | None:
    """Contents of the members that the data is made of, or None where one is not complete or not right.

    There is more than one where a member's first bytes hold the magic: what stands before that is too short
    to be seen as a record's start, so the member was added to the one before it.
    """
    out, at = [], 0
    try:
        while at < len(data):
            opened, parts = zlib.decompressobj(31), []
            while not opened.eof:
                if at == len(data):
                    return None
                piece = data[at:at + PIECE_BYTES]
                parts.append(opened.decompress(piece))
                at += len(piece) - len(opened.unused_data)
            out.append(b"".join(parts))
    except zlib.error:
        return None
    return out


#: Columns of a record, as Arrow has them and as Spark does.
FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
          ("payload", pa.binary()), ("digest", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
          ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
RECORDS = ("page_id long, url string, record_type string, refers_to long, payload binary, digest string, "
           "record_id string, refers_to_id string, payload_bytes long, payload_digest string")
#: Fragments: the first part of a member that runs on in another range, or bytes that start no record.
FRAGMENTS = "file string, start long, nr int, opens boolean, part binary"
#: Names that Spark's text source takes for compressed as a whole, and all others.
GZ, NOT_GZ = "*.gz", "{*[!z],*[!g]z,*[!.]gz,z,gz}"
#: Decoded bytes that leave a task together, about.
OUT_BYTES = 1 << 24


def _rows(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Records in batches of bounded size."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += len(r.get("payload") or r.get("part") or b"") + 500
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives below ``path``, of any type and by any writer.

    Columns: page_id and refers_to (of this module's writer, else null), url,
    record_type (lower case, null if not stated), payload (null for a revisit,
    and with ``payloads`` off), payload_bytes and payload_digest (SHA-256, of
    the payload that was read), and as stated digest, record_id, refers_to_id.

    A task's byte range is the session's ``spark.sql.files.maxPartitionBytes``.
    Files called .gz are not split, since Hadoop's readers decompress them as a
    whole: each is one task's. Empty members and empty files have no records;
    bytes that never make a record raise an error when the fragments are
    joined. Without payloads the archives are decoded once and the records
    written as a table; with them they are read once more for the fragments,
    which are rare, rather than kept decoded.
    """
    raw = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").option(
        "pathGlobFilter", NOT_GZ).text(path)
    cut = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.col("value").cast("binary").alias("candidate"))
    schema = pa.schema([*FIELDS, ("file", pa.string()), ("start", pa.int64()),
                        ("nr", pa.int32()), ("opens", pa.bool_()), ("part", pa.binary())])

    def record_of(data: bytes) -> dict:
        found = parse(data)
        return found if payloads else found | {"payload": None}

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nr, open_ = None, 0, None  # open_: parts of the member that is being read
        out: list[dict] = []

        def whole() -> bool:
            """Close the member that is being read, if all of it is there."""
            nonlocal open_
            found = decoded(MAGIC + b"".join(open_)) if open_ else []
            if found is None:
                return False
            out.extend(record_of(data) for data in found if data)
            open_ = None
            return True

        def leave() -> None:
            """At the end of a range: what is not whole goes on in the next one."""
            nonlocal open_, nr
            if not whole():
                nr += 1
                out.append({"file": at[0], "start": at[1], "nr": nr, "opens": True, "part": b"".join(open_)})
                open_ = None

        for batch in batches:
            files, starts, candidates = (batch.column(k) for k in range(3))
            for k in range(batch.num_rows):
                place, candidate = (files[k].as_py(), starts[k].as_py()), candidates[k].as_py()
                fresh = place != at
                if fresh:
                    leave()
                    at, nr = place, 0
                if starts_record(candidate) and whole():  # not inside a member that holds archives itself
                    open_ = [candidate]
                elif open_ is not None:
                    open_ += [MAGIC, candidate]
                elif candidate or not (fresh and at[1] == 0):  # before a file's first magic there is nothing
                    nr += 1
                    out.append({"file": at[0], "start": at[1], "nr": nr, "opens": False, "part": candidate})
                if len(out) >= 1000:
                    yield from _rows(iter(out), schema)
                    out = []
        leave()
        yield from _rows(iter(out), schema)

    held = cut.mapInArrow(members, f"{RECORDS}, {FRAGMENTS}")
    if not payloads:
        held = saved(held, "records")
    fragments = held.where("file is not null")
    in_file = Window.partitionBy("file").orderBy("start", "nr")
    numbered = fragments.withColumn("member", F.sum(F.col("opens").cast("int")).over(in_file))
    glued = numbered.groupBy("file", "member").agg(F.array_sort(F.collect_list(F.struct("start", "nr", "part"))).alias("parts"))

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    found = decoded(MAGIC + MAGIC.join(p["part"] for p in row["parts"]))
                    if found is None:
                        raise ValueError(f"no whole WARC record at {row['parts'][0]['start']} of {row['file']}")
                    yield from (record_of(data) for data in found if data)

        yield from _rows(joined(), pa.schema(FIELDS))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for batch in batches:
                for name, content in zip(batch.column(0), batch.column(1), strict=True):
                    for data in inflated(content.as_buffer(), name.as_py()):
                        yield record_of(data)

        yield from _rows(each(), pa.schema(FIELDS))

    whole_files = spark.read.format("binaryFile").option("pathGlobFilter", GZ).load(path).select("path", "content")
    names = [name for name, _ in FIELDS]
    return held.where("file is null").select(*names).unionByName(glued.mapInArrow(glue, RECORDS)).unionByName(
        whole_files.mapInArrow(unpack, RECORDS))


def inflated(data: pa.Buffer, name: str) -> Iterator[bytes]:
    """Contents of the members of a whole file, one at a time, empty ones left out."""
    at, view = 0, memoryview(data)
    while at < len(view):
        opened, parts = zlib.decompressobj(31), []
        try:
            while not opened.eof:
                piece = view[at:at + PIECE_BYTES]
                if not len(piece):
                    raise zlib.error("cut off")
                parts.append(opened.decompress(piece))
                at += len(piece) - len(opened.unused_data)
        except zlib.error as wrong:
            raise ValueError(f"no whole WARC record before {at} of {name}") from wrong
        if any(parts):
            yield b"".join(parts)


def payloads(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every response and revisit.

    Length and digest are taken from the payload that was read; a revisit has
    those of the response that it refers to by page id and digest, so pages
    that share an id but not the payload are told apart. A revisit of a record
    that is not there has none.
    """
    own = records.select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "digest")
    responses = own.where("record_type = 'response'")
    targets = responses.where("page_id is not null").groupBy(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest")).agg(
        F.max("payload_bytes").alias("payload_bytes"))
    revisits = own.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        targets.withColumn("payload_digest", F.col("digest")), ["refers_to", "digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    path = scratch(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return payloads(read_archives(spark, path, payloads=False))


#: DuckDB form of the query's result.
OP6_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id > first THEN first END AS refers_to
FROM f
"""
