import base64
import gzip
import hashlib

import pytest
from pyspark.sql import types as T

from quire.llm import warc

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("url", "html", "key", "copy")]
)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(2)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (5, "http://a.b/c d", "<p>ü</p>" * 5000),
    (3, "http://x.y", "<p>ü</p>" * 5000),
    (9, None, None),
    (7, "http://e", ""),
    (7, "http://e", ""),
    (11, "http://evil\r\nWARC-Type: x", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 20),
    (12, "u", "one " * 9),
    (None, "u", "one " * 9),
    (None, "v", "only without an id"),
]


@pytest.mark.parametrize("p", [warc.PARAMS, warc.WarcParams(segment_bytes=100, chunk_bytes=33, records_per_file=3)])
def test_round_trip(spark, p):
    got = warc.archive_round_trip(pages(spark, ROWS), p).collect()
    assert len(got) == len(ROWS) and all(r.whole for r in got)
    seen = sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str
    )
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want, done = [], set()
    for i, _, h in ROWS:
        origin = first.get(h or "")
        is_first = (i == origin) and (h or "") not in done
        done.add((h or "")) if is_first else None
        kind = ("response", None) if is_first else ("revisit", origin)
        want.append((i, len((h or "").encode()), digest(h), *kind))
    assert seen == sorted(want, key=str)


def test_small_payloads_are_all_responses(spark):
    p = warc.WarcParams(min_revisit_bytes=10)
    got = warc.archive_round_trip(pages(spark, [(1, "u", "abc"), (2, "u", "abc")]), p).collect()
    assert {r.record_type for r in got} == {"response"}


def test_broken_segments_are_not_whole(spark, tmp_path):
    p = warc.WarcParams(segment_bytes=50)
    records = list(warc.page_records("urn:page:1:k:1", "u", b"x" * 400, None, p))
    whole = list(warc.page_records("urn:page:2:k:1", "u", b"y" * 400, None, p))
    with gzip.open(tmp_path / "a.gz", "wb") as f:
        f.write(b"".join(r + b"\r\n\r\n" for r in reversed(whole)))
    with gzip.open(tmp_path / "b.gz", "wb") as f:
        f.write(b"".join(r + b"\r\n\r\n" for k, r in enumerate(records) if k != 2))
    out = {r.page_id: (r.whole, r.payload_bytes) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert out == {1: (False, None), 2: (True, 400)}


def test_long_payloads_come_back_whole(spark):
    """Payloads of megabytes, equal and distinct, over many segments and chunks."""
    rows = [(1, "u", "<p>é</p>" * 400_000), (2, "u", "<p>é</p>" * 400_000), (3, "u", "x" * 41_000), (4, "u", "x" * 3_000_000)]
    p = warc.WarcParams(segment_bytes=64 << 10, chunk_bytes=8 << 10)
    got = {r.page_id: r for r in warc.archive_round_trip(pages(spark, rows), p).collect()}
    for i, _, html in rows:
        assert got[i].whole and got[i].payload_bytes == len(html.encode()) and got[i].payload_digest == digest(html)
    assert (got[2].record_type, got[2].refers_to) == ("revisit", 1)


def test_empty_table(spark):
    assert warc.archive_round_trip(pages(spark, [])).collect() == []


@pytest.mark.parametrize("payload", [b"", b"a", b"\r\n0\r\n\r\n", bytes(range(256)) * 40])
@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunk_framing(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert warc.unchunked(warc.chunked(payload, size)[:-4]) is None or not payload
