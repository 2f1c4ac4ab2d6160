"""WARC archives: writing with segmentation, reading with reassembly.

write_archives turns rows into WARC/1.1 records. A payload is carried in an
HTTP response block with chunked transfer framing; a block longer than
SEGMENT_BYTES is cut into a first record and continuation records
(WARC-Segment-Number, WARC-Segment-Origin-ID, WARC-Segment-Total-Length on the
last). Of equal payloads the row of the largest id is the response and the others are
revisit records without a payload. Every row has a record id of its own (its place in the input, which
scans of files repeat), and carries its page id as a field, so that ids may be missing or stand twice. Files are written by Spark's text writer
with the record terminator CRLF CRLF as line separator, so any file system
that Spark writes to will do; each task's file is gzip-compressed.

read_archives reads whole files (one per writing task, so their size is set by
the number of partitions), cuts them by Content-Length, groups continuation
records by origin id, orders them by segment number, verifies that no number
is missing and that the total length is right, and decodes the chunked framing.
Segmented records meet by origin id: one payload per group, never more.

Defined results: a null payload is an empty one; equal empty payloads are
revisits too (min_revisit_bytes=0); rows that share an id are records of their own (of equal
payloads the later row is the response, the other refers to the same id); null ids come
before all others and read back as null; a null url is
written as an empty target; damaged or incomplete records raise ValueError; an
empty table writes no records and reads back no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import saved, scratch

SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS, DATE = 16_384, 4096, 5000, "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
END = "\r\n\r\n"


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + CRLF + block


def records_of(key: str, url: str, payload: bytes, response: str | None, segment_bytes: int = SEGMENT_BYTES, page: str | None = None, refers: str | None = None) -> list[bytes]:
    """All records of one row; response: the record a revisit refers to; page, refers: the page ids of both."""
    urn = f"<urn:page:{key}>"
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    common = [("X-Page-ID", page)] * (page is not None) + [("X-Refers-To-Page", refers)] * (refers is not None)
    common += [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", "sha1:" + digest32(hashlib.sha1(payload).digest()))]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if response is not None:
        more = [("WARC-Refers-To", f"<urn:page:{response}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Payload-Length", str(len(payload)))]
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", urn), *common, *more], head)]
    block = head + chunked(payload)
    kind = [("WARC-Type", "response"), ("WARC-Record-ID", urn), *common, ("Content-Type", "application/http;msgtype=response")]
    if len(block) <= segment_bytes:
        return [_record(kind, block)]
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    out = [_record([*kind, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{key}:{n}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", urn), ("WARC-Segment-Number", str(n))]
        out.append(_record(more + [("WARC-Segment-Total-Length", str(len(block)))] * (n == len(parts)), part))
    return out


def write_archives(rows: DataFrame, path: str, *, key="page_id", url="url", payload="html", min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    d = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("payload"))
    sums = d.select("row", "key", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")).where(F.col("n") >= min_revisit_bytes)
    last = F.struct(F.col("key").isNotNull().alias("some"), F.col("key").alias("refers"), F.col("row").alias("response"))
    groups = sums.groupBy("sha").agg(F.max(last).alias("top"), F.count("*").alias("k")).where("k > 1").select("sha", "top.refers", "top.response")
    revisits = saved(sums.join(saved(groups), "sha").where("row <> response").select("row", "refers", "response"))
    d = d.join(revisits, "row", "left") if not revisits.isEmpty() else d.withColumns({"refers": F.lit(None).cast("long"), "response": F.lit(None).cast("long")})

    def run(batches):
        text = lambda x: None if x is None else str(x)
        for b in batches:
            out = []
            for n, k, u, p, f, r in zip(*(b.column(c).to_pylist() for c in ("row", "key", "url", "payload", "refers", "response")), strict=True):
                out += records_of(str(n), u, p, text(r), segment_bytes, text(k), text(f))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = d.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip").text(path)


def parse(raw: bytes):
    """(header fields, block) of every record of an archive's bytes."""
    if raw[:2] == b"\x1f\x8b":
        out = []
        while raw:
            z = zlib.decompressobj(31)
            out.append(z.decompress(raw))
            raw = z.unused_data
        raw = b"".join(out)
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {}
        for line in raw[at:end].split(CRLF)[1:]:
            k, _, v = line.partition(b":")
            fields[k.decode().lower()] = v.strip().decode()
        start, size = end + 4, int(fields["content-length"])
        if raw[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, raw[start : start + size]
        at = start + size + 4


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


PART = "origin string, segment int, total long, kind string, refers string, url string, digest string, length long, page long, refers_page long, block binary"
PAGE = "record_id string, kind string, refers string, url string, payload_bytes long, payload_digest string, page long, refers_page long, payload binary"


def _cut(with_payload: bool):
    def run(batches):
        names = [c.split()[0] for c in PART.split(", ")]
        for b in batches:
            for raw in b.column("content").to_pylist():
                out, size = [], 0
                for f, block in parse(raw):
                    kind, number = f["warc-type"], int(f.get("warc-segment-number", 0))
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    digest, length = f.get("warc-payload-digest", "").removeprefix("sha1:"), int(f.get("x-payload-length", 0))
                    if number == 0 and kind == "response":
                        block = payload_of(block)
                        digest, length = digest32(hashlib.sha1(block).digest()), len(block)
                        block = block if with_payload else None
                    total = f.get("warc-segment-total-length")
                    out.append((f.get("warc-segment-origin-id", f["warc-record-id"]), number, None if total is None else int(total), kind, f.get("warc-refers-to"), f.get("warc-target-uri"), digest, length, *(int(f[c]) if c in f else None for c in ("x-page-id", "x-refers-to-page")), block if kind != "revisit" else None))
                    size += len(block or b"")
                    if size > 8_000_000:
                        yield _batch(out, names)
                        out, size = [], 0
                if out:
                    yield _batch(out, names)

    return run


_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _batch(rows, names):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)


def _join(with_payload: bool):
    def run(key, t):
        rows = sorted(t.to_pylist(), key=lambda r: r["segment"])
        if [r["segment"] for r in rows] != list(range(1, len(rows) + 1)) or rows[-1]["total"] is None:
            raise ValueError(f"segments of {key[0]} are not whole: {[r['segment'] for r in rows]}")
        block = b"".join(r["block"] for r in rows)
        if len(block) != rows[-1]["total"]:
            raise ValueError(f"{key[0]} has {len(block)} bytes, not {rows[-1]['total']}")
        body = payload_of(block)
        first = rows[0]
        return pa.table([[first["origin"]], [first["kind"]], pa.array([first["refers"]], pa.string()), pa.array([first["url"]], pa.string()), [len(body)], [digest32(hashlib.sha1(body).digest())], pa.array([first["page"]], pa.int64()), pa.array([first["refers_page"]], pa.int64()), pa.array([body if with_payload else None], pa.binary())], names=[c.split()[0] for c in PAGE.split(", ")])

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per whole record: id, type, refers_to, url, length, digest, page ids where the archive has them, payload."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInArrow(_cut(with_payload), PART)
    # both uses must read each file once: only segments are kept for the second
    parts = saved(parts)
    whole = parts.where("segment = 0").select(F.col("origin").alias("record_id"), "kind", "refers", "url", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "page", "refers_page", F.col("block").alias("payload"))
    return whole.unionByName(parts.where("segment > 0").groupBy("origin").applyInArrow(_join(with_payload), PAGE))


def warc_round_trip(pages: DataFrame, *, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages' archives, read them back and report each page."""
    spark = pages.sparkSession
    path = scratch(spark)
    write_archives(pages, path, min_revisit_bytes=min_revisit_bytes)
    back = read_archives(spark, path, with_payload=False)
    return back.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("refers_page").alias("refers_to"))


#: DuckDB SQL of warc_round_trip's rows where page ids are unique: 5 hexadecimal digits of SHA-1 are 4 of base32.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS s, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(s, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM q
"""
