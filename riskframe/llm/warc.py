"""WARC from legacy ARC archives.

``write_arc`` stores pages as ARC files (version 1 and 2, file by file),
``read_arc`` parses them: the version block of each file names the fields of its
header lines, and every record is as long as its header declares.  ``to_warc``
synthesises the WARC equivalents: record ids (name-based UUIDs over page and
digest), ISO timestamps, types, and digests.  Of records with equal payloads of
at least ``MIN_DEDUP`` bytes the one with the largest page_id is the response, the
others revisit it.  ``write_warc`` and ``read_warc`` store and parse the archives.

Archives are written by Spark's text sink, one record a row, with the record
separator of the format as line separator, so they lie in the shared folder,
go through the commit protocol, and survive lost executors.  They are read with
the ``binaryFile`` source, and decompressed and parsed as streams.

Defined cases: null html is an empty payload; a null url is ``urn:none`` and null
again when read; white space in urls is percent-encoded; a null page_id never
wins a group (a group without any page_id has responses only); repeated rows of
the winning page_id are all responses; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, column_or_null, map_batches, shared_path, stage, table

MIN_DEDUP = 1000
NO_URL = "urn:none"
CAPTURED = "20240101000000"              # of pages that have no date of their own
BLANK = re.compile(r"[\x00-\x20\x7f]")
NAMESPACE = uuid.UUID("6f0c4be2-3c0b-5a39-9a52-8a2f4f8b2c11")
ROWS = 256                               # records of one Arrow batch
BROADCAST_ROWS = 100_000                 # (digest, page) keys of revisits; more are joined

# Field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def _http_head(page_id: int | None, length: int) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n{own}\r\n".encode()


def _http_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


# ------------------------------------------------------------------ ARC

def arc_header(version: int, url: str, length: int, mime: str = "text/html", date: str = CAPTURED) -> str:
    middle = "" if version == 1 else "200 - - 0 - "
    return f"{url} 0.0.0.0 {date} {mime} {middle}{length}"


def _arc_pass(batches):
    part = TaskContext.get().partitionId()
    version = 1 + part % 2
    block = f"{version} 0 pages\n{ARC_FIELDS[version]}\n"
    first = [f"{arc_header(version, f'filedesc://part-{part}.arc', len(block), 'text/plain')}\n{block}"]
    for rb in batches:
        for a in range(0, rb.num_rows, ROWS):
            out = first
            first = []
            for row in rb.slice(a, ROWS).to_pylist():
                body = (row["html"] or "").encode()
                body = _http_head(row["page_id"], len(body)) + body
                url = NO_URL if row["url"] is None else BLANK.sub(lambda m: f"%{ord(m[0]):02X}", row["url"])
                out.append(f"{arc_header(version, url or '-', len(body))}\n{body.decode()}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def write_arc(pages: DataFrame, path: str) -> None:
    rows = pages.select(column_or_null(pages, "page_id", "long").alias("page_id"), column_or_null(pages, "url", "string").alias("url"),
                        column_or_null(pages, "html", "string").alias("html"))
    (map_batches(rows, _arc_pass, "value string").write.option("lineSep", "\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def parse_arc(stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of the records of an ARC file."""
    fields = None
    while line := stream.readline():
        line = line.rstrip(b"\r\n").decode()
        if not line:
            continue
        if fields is None:
            block = stream.read(int(line.rsplit(" ", 1)[1])).decode().split("\n")
            fields = [f.lower() for f in block[1].split(" ")]
            if block[0].split(" ")[0] not in ("1", "2"):
                raise ValueError(f"unknown ARC version line {block[0]!r}")
            continue
        values = line.split(" ")
        if len(values) != len(fields):
            raise ValueError(f"ARC header has {len(values)} fields, its file declares {len(fields)}")
        header = dict(zip(fields, values))
        size = int(header["archive-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("ARC record shorter than its declared length")
        yield header, block


def _streams(rb):
    for content in rb.column("content"):
        yield gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))


ARC_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("mime", pa.string()),
                        ("payload_bytes", pa.int64()), ("digest", pa.string())])


def _batches(rows: Iterator[tuple], schema: pa.Schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arc_rows(payload: bool):
    schema = ARC_SCHEMA.append(pa.field("payload", pa.string())) if payload else ARC_SCHEMA

    def run(batches):
        def rows():
            for rb in batches:
                for stream in _streams(rb):
                    for header, block in parse_arc(stream):
                        head, _, body = block.partition(b"\r\n\r\n")
                        own = _http_fields(head).get("x-page-id")
                        yield (None if own is None else int(own), None if header["url"] == NO_URL else header["url"],
                               header["archive-date"], header["content-type"], len(body), hashlib.sha1(body).hexdigest(),
                               *([body.decode()] if payload else []))
        return _batches(rows(), schema)
    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_arc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    return map_batches(_files(spark, path), _arc_rows(payload),
                       "page_id long, url string, date string, mime string, payload_bytes long, digest string"
                       + ", payload string" * payload)


# ------------------------------------------------------------------ WARC

def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id} {digest}')}>"


def _fields(pairs) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None) + "\r\n"


def _warc_pass(batches):
    info = "software: arc conversion\r\nformat: WARC File Format 1.1\r\n"
    part = TaskContext.get().partitionId()
    first = [_fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"part {part}", "")),
                      ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields"),
                      ("Content-Length", len(info))]) + info + "\r\n"]
    for rb in batches:
        for a in range(0, rb.num_rows, ROWS):
            out = first
            first = []
            for r in rb.slice(a, ROWS).to_pylist():
                revisit = r["winner"] is not None and r["winner"] != r["page_id"]
                head = _http_head(r["page_id"], r["payload_bytes"]).decode()
                block = head if revisit else head + r["payload"]
                d = r["date"]
                out.append(_fields([
                    ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(r["page_id"], r["digest"])),
                    ("WARC-Target-URI", r["url"]), ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(r["digest"])).decode()),
                    ("WARC-Identified-Payload-Type", r["mime"]),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
                    ("WARC-Refers-To", record_id(r["winner"], r["digest"]) if revisit else None),
                    ("X-Refers-To-Page-Id", r["winner"] if revisit else None),
                    ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block.encode()))])
                    + block + "\r\n")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])


def to_warc(spark: SparkSession, arc_path: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The WARC records (``value``) of the ARC files.  Winners of equal payloads,
    and the revisits they make, come from the headers and digests alone; a revisit
    holds no payload, so it is written from them.  The payloads are read once more
    for the responses.  They are never shuffled by digest: the revisits are taken
    out by (digest, page), where they are read if the revisits are few (counted),
    otherwise in an even join of the rows that may be one."""
    heads = stage(read_arc(spark, arc_path, payload=False), "heads")
    winners = (heads.filter(F.col("payload_bytes") >= MIN_DEDUP).groupBy("digest")
               .agg(F.max("page_id").alias("winner"), F.count("*").alias("rows")).filter("rows > 1 and winner is not null").drop("rows"))
    revisits = stage(heads.join(winners, "digest").filter("page_id is null or page_id <> winner"), "revisits")
    gone = revisits.select(F.col("digest").alias("_d"), F.col("page_id").alias("_p")).distinct()
    records = read_arc(spark, arc_path)
    same = (F.col("digest") == F.col("_d")) & F.col("page_id").eqNullSafe(F.col("_p"))
    if gone.count() <= broadcast_rows:
        responses = records.join(F.broadcast(gone), same, "left_anti")
    else:
        clear, others = apart(records, F.xxhash64("digest", "page_id"), gone.select(F.xxhash64("_d", "_p").alias("key")))
        responses = clear.unionByName(others.join(gone, same, "left_anti"))
    every = responses.withColumn("winner", F.lit(None).cast("long")).unionByName(revisits.withColumn("payload", F.lit("")))
    return map_batches(every, _warc_pass, "value string")


def write_warc(records: DataFrame, path: str) -> None:
    (records.write.option("lineSep", "\r\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def parse_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of the records of a WARC file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("WARC record does not end where its length says")
        yield fields, block


READ_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                         ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("record_id", pa.string()),
                         ("warc_date", pa.string())])


def _warc_rows(batches):
    def rows():
        for rb in batches:
            for stream in _streams(rb):
                for fields, block in parse_warc(stream):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    head, _, body = block.partition(b"\r\n\r\n")
                    http = _http_fields(head)
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if fields["warc-type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError("payload does not have its digest")
                    own, other = http.get("x-page-id"), fields.get("x-refers-to-page-id")
                    yield (None if own is None else int(own), int(http["content-length"]), digest, fields["warc-type"],
                           None if other is None else int(other), fields.get("warc-target-uri"), fields["warc-record-id"],
                           fields["warc-date"])
    return _batches(rows(), READ_SCHEMA)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return map_batches(_files(spark, path), _warc_rows,
                       "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                       "url string, record_id string, warc_date string")


def convert(pages: DataFrame) -> DataFrame:
    """Pages through ARC files and WARC files, as read back from the latter."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    write_warc(to_warc(spark, arc), warc)
    return read_warc(spark, warc)


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert(table(spark, sf_dir, "pages")).drop("url", "record_id", "warc_date")


QUERIES = {"op1_warc": q_warc}
ORACLES = {"op1_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
top AS (SELECT d, max(page_id) AS winner, count(*) AS c FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN top.c > 1 AND top.winner <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top.c > 1 AND top.winner <> p.page_id THEN top.winner END AS refers_to
FROM p LEFT JOIN top ON p.d = top.d"""}
