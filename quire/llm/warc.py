"""Writing web pages as WARC archives and reading them back, segments reassembled.

Writing: one ``response`` record per distinct payload (the smallest page_id of
equal ones), a ``revisit`` record for every other page.  The block is an HTTP
response with chunked transfer framing.  A block over ``segment_bytes`` is cut:
the first part is the origin record, the others are ``continuation`` records
with the origin's identifier and their number; the last one has the total length.

Reading: records are parsed by their Content-Length from the gzip stream of each
file.  Segments are grouped by origin identifier and put in order of their
number; the record counts as whole if the numbers run from 1 without a gap and
the lengths add up to the stated total; then the chunk framing is decoded.

Defined results: a null html is an empty payload; a null url has no target
header; rows that repeat a page_id and payload give one response (or none) and
revisits; a null page_id stays null and is the response only if no page with an
id has the payload; a record that is not whole has null payload columns and
``whole`` false; payloads of any length are cut into segments and come back whole;
an empty table gives no archive and an empty result.  Only ``page_id``, ``url``
and ``html`` are looked at, whatever other columns are called.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import written
from quire.session import scratch_path

_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class WarcParams:
    #: payloads of at least this many bytes are written once
    min_revisit_bytes: int = 0
    segment_bytes: int = 1 << 15
    chunk_bytes: int = 4096
    #: bounds a file: this many records of at most a segment each
    records_per_file: int = 4000


PARAMS = WarcParams()


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        parts.append(b"%x\r\n%s\r\n" % (len(part), part))
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or end + 2 + size > len(body):
            return None
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            return None
        at += 2


def http_payload(block: bytes) -> bytes | None:
    head = block.find(_END)
    if head < 0:
        return None
    body = block[head + 4 :]
    return unchunked(body) if b"transfer-encoding: chunked" in block[:head].lower() else body


def _record(kind: str, record_id: str, block: bytes, *more: tuple[str, str | int | None]) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}"]
    head += [f"{k}: {v}" for k, v in more if v is not None]
    head.append(f"Content-Length: {len(block)}")
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + _END + block


def page_records(
    record_id: str, url: str | None, payload: bytes, refers_to: str | None, p: WarcParams = PARAMS
) -> Iterator[bytes]:
    """The record of a page, or its segments."""
    uri = ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    digest = ("WARC-Payload-Digest", "sha1:" + payload_digest(payload))
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = (("WARC-Profile", profile), ("WARC-Refers-To", f"<{refers_to}>"))
        yield _record("revisit", record_id, b"", uri, digest, *more)
        return
    block = _HTTP + chunked(payload, p.chunk_bytes)
    http = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= p.segment_bytes:
        yield _record("response", record_id, block, uri, digest, http)
        return
    cuts = range(0, len(block), p.segment_bytes)
    for k, i in enumerate(cuts, 1):
        part, number = block[i : i + p.segment_bytes], ("WARC-Segment-Number", k)
        if k == 1:
            yield _record("response", record_id, part, uri, digest, http, number)
        else:
            total = ("WARC-Segment-Total-Length", len(block) if k == len(cuts) else None)
            origin = ("WARC-Segment-Origin-ID", f"<{record_id}>")
            yield _record("continuation", f"{record_id}:{k}", part, uri, origin, number, total)


def _write_batches(p: WarcParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for rid, url, html, ref in zip(*(batch.column(i) for i in range(4)), strict=True):
                payload = (html.as_py() or "").encode()
                for rec in page_records(rid.as_py(), url.as_py(), payload, ref.as_py(), p):
                    out.append(rec)
                    size += len(rec)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def _record_id(page: str, key: str, copy: Column) -> Column:
    return F.concat_ws(":", F.lit("urn:page"), page, key, copy)


def write_archives(pages: DataFrame, path: str, p: WarcParams = PARAMS) -> None:
    """Writes the pages' records to ``path`` as files of records (.txt.gz, WARC/1.1)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("key", F.sha1(F.encode("html", "UTF-8")))
    # the id as text, never null: the numbering and the join below share one shuffle of the pages
    rows = rows.withColumn("id", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    slim = rows.select("page_id", "id", "key", F.octet_length("html").alias("size"))
    # the pages of a payload that several have; its first page is the response
    firsts = (
        slim.filter(F.col("size") >= p.min_revisit_bytes)
        .groupBy("key")
        .agg(F.count("*").alias("pages"), F.min("page_id").alias("first"))
        .filter("pages > 1")
        .select("key", F.coalesce(F.col("first").cast("string"), F.lit("")).alias("first"))
    )
    again = slim.select("id", "key").distinct().join(firsts, "key").select("id", "key", "first")
    copy = W.partitionBy("id", "key").orderBy("url")
    both = rows.withColumn("copy", F.row_number().over(copy)).join(again, ["id", "key"], "left")
    repeated = F.col("first").isNotNull() & ~((F.col("id") == F.col("first")) & (F.col("copy") == 1))
    records = both.select(
        _record_id("id", "key", F.col("copy").cast("string")).alias("record_id"),
        "url",
        "html",
        F.when(repeated, _record_id("first", "key", F.lit("1"))).alias("refers_to"),
    ).mapInArrow(_write_batches(p), "record binary")
    # the text writer puts the bytes as they are and the end of a record after each
    (
        records.select(F.col("record").cast("string"))
        .write.option("compression", "gzip")
        .option("lineSep", _END.decode())
        .option("maxRecordsPerFile", p.records_per_file)
        .text(path)
    )


_RECORD = (
    "record_id string, kind string, origin string, number long, total long, refers_to string, "
    "stated_digest string, payload_bytes long, payload_digest string, block binary"
)
_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


class _Inflated(io.RawIOBase):
    """Reads a gzip (or plain) file's bytes piece by piece."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.rest = raw, 0, b""
        self.z = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.rest and self.at < len(self.raw):
            part = self.raw[self.at : self.at + 65536]
            self.at += len(part)
            if self.z is None:
                self.rest = part
                continue
            self.rest = self.z.decompress(part)
            while self.z.eof and self.z.unused_data:  # the next gzip member
                part, self.z = self.z.unused_data, zlib.decompressobj(31)
                self.rest += self.z.decompress(part)
        n = min(len(out), len(self.rest))
        out[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of the records of a file."""
    stream = io.BufferedReader(_Inflated(raw), 1 << 16)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue  # the empty lines between records
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.partition(b":")
            head[k.decode().strip().lower()] = v.decode().strip()
        yield head, stream.read(int(head["content-length"]))


def _bare(x: str | None) -> str | None:
    return None if x is None else x.strip("<>")


def _number(x: str | None) -> int | None:
    return None if x is None else int(x)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema(
        [(n, pa.binary() if n == "block" else pa.int64() if t == "long" else pa.string())
         for n, t in (x.split() for x in _RECORD.split(", "))]
    )
    for batch in batches:
        for content in batch.column(0):
            out, size = [], 0
            for head, block in parse(content.as_buffer().to_pybytes()):
                number = _number(head.get("warc-segment-number"))
                digest = (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                row = {
                    "record_id": _bare(head.get("warc-record-id")), "kind": head.get("warc-type"),
                    "origin": _bare(head.get("warc-segment-origin-id")), "number": number,
                    "total": _number(head.get("warc-segment-total-length")),
                    "refers_to": _bare(head.get("warc-refers-to")), "stated_digest": digest,
                }
                if number is not None:
                    row |= {"block": block}
                    row["origin"] = row["origin"] or row["record_id"]
                elif row["kind"] == "response" and (payload := http_payload(block)) is not None:
                    row |= {"payload_bytes": len(payload), "payload_digest": payload_digest(payload)}
                out.append(row)
                size += len(row.get("block", b"")) + 200
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, kinds)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, kinds)


def _join_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records from their ordered segments: checks numbers and total length, decodes the framing."""
    for batch in batches:
        out = []
        for origin, parts, digest in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            parts = parts.as_py()
            block = b"".join(x["block"] for x in parts)
            in_order = [x["number"] for x in parts] == list(range(1, len(parts) + 1))
            payload = http_payload(block) if in_order and parts[-1]["total"] == len(block) else None
            out.append(
                {
                    "record_id": origin.as_py(),
                    "stated_digest": digest.as_py(),
                    "payload_bytes": None if payload is None else len(payload),
                    "payload_digest": None if payload is None else payload_digest(payload),
                }
            )
        fields = [("record_id", pa.string()), ("stated_digest", pa.string())]
        fields += [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        yield pa.RecordBatch.from_pylist(out, pa.schema(fields))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; segments with their block."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_batches, _RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, payload_bytes, payload_digest, record_type, refers_to, whole per page."""
    records = written(read_records(spark, path), "warc-records")  # parsed once, used three times
    cols = ["record_id", "stated_digest", "payload_bytes", "payload_digest"]
    plain = records.filter("number is null and kind = 'response'").select(*cols)
    parts = records.filter("number is not null")
    joined = (
        parts.groupBy("origin")
        .agg(
            F.sort_array(F.collect_list(F.struct("number", "total", "block"))).alias("parts"),
            F.max("stated_digest").alias("stated_digest"),
        )
        .mapInArrow(
            _join_batches, "record_id string, stated_digest string, payload_bytes long, payload_digest string"
        )
    )
    responses = plain.unionByName(joined)
    revisits = records.filter("kind = 'revisit'").select("record_id", "refers_to", "stated_digest")
    target = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("payload_bytes").alias("n"),
        F.col("payload_digest").alias("found"),
    )
    resolved = revisits.join(target, "refers_to", "left").select(
        "record_id",
        "stated_digest",
        F.when(F.col("found") == F.col("stated_digest"), F.col("n")).alias("payload_bytes"),
        F.when(F.col("found") == F.col("stated_digest"), F.col("found")).alias("payload_digest"),
        F.lit("revisit").alias("record_type"),
        "refers_to",
    )
    both = responses.select(
        *cols, F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to")
    ).unionByName(resolved)
    page = lambda c: F.nullif(F.split(c, ":")[2], F.lit("")).cast("long")
    return both.select(
        "record_id",
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
        F.coalesce(F.col("payload_digest") == F.col("stated_digest"), F.lit(False)).alias("whole"),
    )


def archive_round_trip(pages: DataFrame, p: WarcParams = PARAMS) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, p)
    return read_archives(spark, path)
