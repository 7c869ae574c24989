"""Repeated passages across documents: a sparse, distributed suffix order with previous factors.

What is removed: every byte covered by a ``length``-byte string that also starts
in a document with a smaller doc_id.  In terms of longest-previous-factor
arrays: a position goes when the longest factor it shares with an earlier
document reaches ``length``; the earlier match is the position's neighbour with
a smaller document in suffix order (its previous or next smaller value).

A full suffix array of the corpus would have an entry per byte.  Here it is
sparse: every ``length``-byte window belongs to the anchor of least hash among
its ``gram``-byte grams, so equal windows have equal anchors, and one anchor
stands for a run of neighbouring windows (a span, some 17 windows on average).

1. Documents are dealt into buckets of bounded size.  Each bucket reports its
   distinct anchors; anchors found in several buckets go back to those buckets.
2. Each bucket reports the distinct spans of shared anchors with the smallest
   document of each.  Equal spans have one first document; nothing else is
   needed where an anchor has a single span.
3. Where an anchor has several spans, one bucket sends the bytes of each.  Their
   windows are put in suffix order up to ``length`` bytes; in a run of equal
   prefixes (common prefix >= length) the smallest document is the previous
   smaller value of all the others.
4. Each bucket marks the windows with an earlier document and cuts their bytes.

A hot passage counts once per bucket at each step, however many documents hold
it.  Anchors with very many different spans are resolved window by window with
a shuffle instead of in one task.

Defined results: null texts are empty; matches never cross documents; rows with
one doc_id never remove each other's bytes; rows with a null doc_id neither
lose bytes nor make others lose any; texts of any length are treated whole; an
empty table gives an empty result.  Columns other than ``doc_id`` and ``text``
are only carried along.  Anchors with up to ``spans_in_task`` spans are resolved
in one task, others by a shuffle; both give the same result.  Spans are equal
if their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import text_bytes


@dataclass(frozen=True)
class RepeatParams:
    length: int = 50
    gram: int = 20
    #: text bytes of a bucket: what one task holds
    bucket_bytes: int = 16 << 20
    #: anchors with more spans than this are resolved by a shuffle of windows
    spans_in_task: int = 200_000
    #: windows of one span at most (periodic text has long runs of one anchor)
    run: int = 62


PARAMS = RepeatParams()
_CHUNK = 1 << 18


@dataclass
class _Anchors:
    """Anchors of a bucket: row in its table, first window, number of windows, anchor and span hash."""

    row: np.ndarray
    at: np.ndarray
    n: np.ndarray
    gram: np.ndarray
    span: np.ndarray


def _chunk_anchors(buf: np.ndarray, starts: np.ndarray, p: RepeatParams):
    """(first window, windows, anchor hash, span hash) of the runs of one chunk."""
    size, width = len(buf), p.length - p.gram + 1
    if size < p.length:
        return None
    run = tk.prefix_hash(buf)
    _, down = tk.powers(size)
    least = tk.mix((run[p.gram :] - run[: -p.gram]) * down[: size - p.gram + 1])
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    inside = np.ones(len(least), dtype=bool)
    for e in starts[1:-1]:
        inside[max(0, e - p.length + 1) : e] = False
    begin = inside.copy()
    begin[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    s = np.flatnonzero(begin)
    if not len(s):
        return None
    stop = np.append(np.flatnonzero(~inside), len(least))
    e = np.minimum(np.append(s[1:], len(least)), stop[np.searchsorted(stop, s)])
    pieces = -(-(e - s) // p.run)
    if (pieces > 1).any():
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        last = np.repeat(e, pieces)
        s = np.repeat(s, pieces) + k * p.run
        e = np.minimum(s + p.run, last)
    return s, e - s, least[s], tk.span_hash(run, s, e + (p.length - 1))


def _bucket_anchors(table: pa.Table, p: RepeatParams) -> _Anchors:
    parts, row0 = [], 0
    for text in table.column("text").chunks:
        for lo, hi, buf, starts in tk.chunks(text, _CHUNK):
            found = _chunk_anchors(buf, starts, p)
            if found:
                s, n, gram, span = found
                doc = np.searchsorted(starts, s, side="right") - 1
                parts.append((row0 + lo + doc, s - starts[doc], n, gram, span))
        row0 += len(text)
    if not parts:
        z = np.zeros(0, np.int64)
        return _Anchors(z, z, z, z.astype(np.uint64), z.astype(np.uint64))
    row, at, n, gram, span = (np.concatenate(x) for x in zip(*parts, strict=True))
    known = ~np.asarray(table.column("doc_id").is_null())[row] if table.column("doc_id").null_count else slice(None)
    return _Anchors(row[known].astype(np.int32), at[known], n[known].astype(np.int32), gram[known], span[known])


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()


def _signed(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64).view(np.uint64)


def _span_bytes(table: pa.Table, rows: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.Array:
    text = table.column("text").combine_chunks()
    if isinstance(text, pa.ChunkedArray):
        text = text.chunk(0)
    _, offsets, data = text.buffers()[-3:]
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    off = np.frombuffer(offsets, dtype=kind)[text.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    begin = off[rows] + at
    ends = np.concatenate(([0], np.cumsum(size)))
    take = np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw[take])]
    )


def _first_of(gram: np.ndarray, span: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Index of an entry with the smallest document for each distinct (anchor, span)."""
    order = np.lexsort((doc, span, gram))
    g, s = gram[order], span[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    return order[new]


def _in_sorted(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), dtype=bool)
    k = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return sorted_[k] == values


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a batch by bucket, each bucket's as one compressed block."""
    how = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        order = np.argsort(bucket, kind="stable")
        names = batch.schema.names[1:]
        docs = pa.RecordBatch.from_arrays([batch.column(i + 1) for i in range(len(names))], names=names)
        at = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) > 0))) if len(order) else order
        out = []
        for i, j in zip(at, np.append(at[1:], len(order)), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema, options=how) as writer:
                writer.write_batch(docs.take(pa.array(order[i:j])))
            out.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[order][at], pa.int32()), pa.array(out, pa.binary())], names=["bucket", "block"]
        )


def _unpack(table: pa.Table) -> tuple[int, pa.Table]:
    """(bucket, its documents)."""
    blocks = table.column("block")
    docs = [pa.ipc.open_stream(pa.py_buffer(b.as_buffer())).read_all() for b in blocks]
    return table.column("bucket")[0].as_py(), pa.concat_tables(docs)


def _report_anchors(p: RepeatParams):
    def run(packed: pa.Table) -> pa.Table:
        number, table = _unpack(packed)
        grams = np.unique(_bucket_anchors(table, p).gram)
        bucket = pa.array(np.full(len(grams), number, np.int32))
        return pa.table({"gram": pa.array(grams.view(np.int64)), "bucket": bucket})

    return run


def _report_spans(p: RepeatParams):
    """Distinct spans, in this bucket, of anchors that other documents have."""

    def run(packed: pa.Table, shared: pa.Table) -> pa.Table:
        number, table = _unpack(packed)
        a, ids = _bucket_anchors(table, p), _ids(table)
        doc = ids[a.row]
        order = np.lexsort((doc, a.gram))
        g, d = a.gram[order], doc[order]
        # anchors that several documents of this bucket have
        twice = np.unique(g[1:][(g[1:] == g[:-1]) & (d[1:] != d[:-1])])
        use = _in_sorted(a.gram, np.sort(_signed(shared, "gram"))) | _in_sorted(a.gram, twice)
        a = _Anchors(*(x[use] for x in (a.row, a.at, a.n, a.gram, a.span)))
        doc = doc[use]
        one = _first_of(a.gram, a.span, doc)
        return pa.table(
            {
                "gram": pa.array(a.gram[one].view(np.int64)),
                "span": pa.array(a.span[one].view(np.int64)),
                "bucket": pa.array(np.full(len(one), number, np.int32)),
                "doc": pa.array(doc[one]),
            }
        )

    return run


def _report_bytes(p: RepeatParams):
    """Bytes of the wanted spans: those of this bucket's documents that hold them first."""

    def run(packed: pa.Table, wanted: pa.Table) -> pa.Table:
        _, table = _unpack(packed)
        docs = np.unique(wanted.column("doc").to_numpy()) if len(wanted) else np.zeros(0, np.int64)
        table = table.take(pa.array(np.flatnonzero(_in_sorted(_ids(table), docs)))).combine_chunks()
        a = _bucket_anchors(table, p) if len(table) else None
        if a is None or not len(a.row):
            one = np.zeros(0, np.int64)
            return pa.table(
                {k: pa.array(one) for k in ("gram", "span", "doc")} | {"bytes": pa.array([], pa.binary())}
            )
        doc = _ids(table)[a.row]
        one = _first_of(a.gram, a.span, doc)
        one = one[_in_sorted(a.span[one], np.unique(_signed(wanted, "span")))]
        return pa.table(
            {
                "gram": pa.array(a.gram[one].view(np.int64)),
                "span": pa.array(a.span[one].view(np.int64)),
                "doc": pa.array(doc[one]),
                "bytes": _span_bytes(table, a.row[one], a.at[one], a.n[one].astype(np.int64) + p.length - 1),
            }
        )

    return run


def previous_factors(grams: np.ndarray, docs: np.ndarray, spans: pa.Array, length: int):
    """For every window of the spans the smallest document that has it, in suffix order.

    Suffixes start at the windows and are compared up to ``length`` bytes, within
    an anchor.  Returns (span index, window in span, smallest document).
    """
    off = np.frombuffer(spans.buffers()[1], np.int32)[spans.offset : spans.offset + len(spans) + 1].astype(np.int64)
    raw = np.frombuffer(spans.buffers()[2], np.uint8)
    n = np.diff(off) - length + 1
    span = np.repeat(np.arange(len(spans)), n)
    first = np.cumsum(n) - n
    window = np.arange(len(span)) - first[span]
    start = off[span] + window
    padded = np.concatenate((raw, np.zeros(16, np.uint8)))
    # eight bytes at every position, most significant first; the last word is cut to the length
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    keys = []
    for k in range(0, length, 8):
        word = np.ascontiguousarray(eight[start + k]).view(">u8").ravel().astype(np.uint64)
        if length - k < 8:
            word >>= np.uint64(8 * (8 - (length - k)))
        keys.append(word)
    keys = [grams[span], *keys]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
    for k in keys:
        x = k[order]
        new[1:] |= x[1:] != x[:-1]
    least = np.minimum.reduceat(docs[span][order], np.flatnonzero(new)) if len(order) else docs[:0]
    out = np.empty(len(order), np.int64)
    out[order] = least[np.cumsum(new) - 1]
    return span, window, out


def _resolve(p: RepeatParams):
    """Streams spans sorted by anchor; whole anchors at a time, no more than needed."""
    names = ["gram", "span", "at", "n", "first"]

    def solve(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        grams, docs = _signed(rows, "gram"), rows.column("doc").to_numpy()
        spans = rows.column("bytes").combine_chunks()
        spans = spans.chunk(0) if isinstance(spans, pa.ChunkedArray) else spans
        span, window, least = previous_factors(grams, docs, spans, p.length)
        go = least < docs[span]
        span, window, least = span[go], window[go], least[go]
        new = np.ones(len(span), dtype=bool)
        new[1:] = (span[1:] != span[:-1]) | (least[1:] != least[:-1]) | (window[1:] != window[:-1] + 1)
        k = np.flatnonzero(new)
        n = np.diff(np.append(k, len(span)))
        of = span[k]
        return pa.RecordBatch.from_arrays(
            [
                rows.column("gram").combine_chunks().take(pa.array(of)),
                rows.column("span").combine_chunks().take(pa.array(of)),
                pa.array(window[k].astype(np.int32)),
                pa.array(n.astype(np.int32)),
                pa.array(least[k]),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            gram = table.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield solve(pa.concat_tables([*held, table.slice(0, cut)]))
                held = []
            elif held and held[-1].column("gram")[-1].as_py() != gram[0]:
                yield solve(pa.concat_tables(held))
                held = []
            held.append(table.slice(cut))
        if held:
            yield solve(pa.concat_tables(held))

    return run


def _cut(p: RepeatParams, rest: bool):
    """Removes the windows that an earlier document has."""

    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        table = _unpack(packed)[1].combine_chunks()
        a, ids = _bucket_anchors(table, p), _ids(table)
        doc = ids[a.row]
        # spans that an earlier document of this bucket has go whole
        one = _first_of(a.gram, a.span, doc)
        g, s, d = a.gram[one], a.span[one], doc[one]
        by = np.argsort(s, kind="stable")
        key, first = s[by], d[by]
        at = np.searchsorted(key, a.span) if len(key) else np.zeros(0, np.int64)
        whole = first[at] < doc if len(key) else np.zeros(0, bool)
        rows, lo, n = [a.row[whole]], [a.at[whole]], [a.n[whole].astype(np.int64)]
        # the others by the replies for their span
        if len(replies):
            span, w, m = _signed(replies, "span"), replies.column("at").to_numpy(), replies.column("n").to_numpy()
            least = replies.column("first").to_numpy()
            left = np.flatnonzero(~whole)
            order = np.argsort(a.span[left], kind="stable")
            left = left[order]
            x = a.span[left]
            b, e = np.searchsorted(x, span, "left"), np.searchsorted(x, span, "right")
            which = np.repeat(np.arange(len(span)), e - b)
            k = left[np.arange(len(which)) - np.repeat(np.cumsum(e - b) - (e - b), e - b) + np.repeat(b, e - b)]
            go = least[which] < doc[k]
            which, k = which[go], k[go]
            rows.append(a.row[k])
            lo.append(a.at[k] + w[which])
            n.append(np.minimum(m[which], a.n[k] - w[which]).astype(np.int64))
        rows, lo, n = np.concatenate(rows), np.concatenate(lo), np.concatenate(n)
        order = np.argsort(rows, kind="stable")
        rows, lo, n = rows[order], lo[order], n[order]
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        row0 = 0
        for text in table.column("text").chunks:
            for c0, c1, buf, starts in tk.chunks(text, _CHUNK):
                i, j = np.searchsorted(rows, [row0 + c0, row0 + c1])
                begin = starts[rows[i:j] - row0 - c0] + lo[i:j]
                gone = np.zeros(len(buf) + 1, dtype=np.int32)
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + n[i:j] + (p.length - 1), -1)
                gone = np.cumsum(gone[:-1]) > 0 if len(buf) else np.zeros(0, bool)
                edge = gone.copy()
                if len(buf):
                    cut = np.zeros(len(buf) + 1, dtype=bool)
                    cut[starts] = True
                    edge[1:] &= ~gone[:-1] | cut[1:-1]
                total = np.concatenate(([0], np.cumsum(gone)))
                runs = np.concatenate(([0], np.cumsum(edge)))
                for r in range(c1 - c0):
                    b, e = int(starts[r]), int(starts[r + 1])
                    lost = int(total[e] - total[b])
                    left = (buf[b:e] if not lost else buf[b:e][~gone[b:e]]).tobytes()
                    out["n_bytes"].append(e - b)
                    out["n_removed"].append(lost)
                    out["n_spans"].append(int(runs[e] - runs[b]))
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                    if rest:
                        out["kept"].append(left.decode("utf-8", "ignore") if lost else None)
            row0 += len(text)
        cols = {"doc_id": table.column("doc_id")}
        cols |= {k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")}
        cols["kept_sha256"] = pa.array(out["kept_sha256"], pa.string())
        if rest:
            import pyarrow.compute as pc

            kept = pa.chunked_array([pa.array(out["kept"], pa.string())])
            cols["text"] = pc.coalesce(kept, table.column("text"))
            cols["rest"] = table.column("rest")
        return pa.table(cols)

    return run


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, p: RepeatParams = PARAMS, carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row.

    With ``carry`` the kept text (``text``, whole characters) and the struct
    ``rest`` of these columns come too.
    """
    buckets = max(1, -(-text_bytes(docs) // p.bucket_bytes))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if carry is not None:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest"))
    deal = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    dealt = docs.select(F.pmod(F.xxhash64(deal), F.lit(buckets)).cast("int").alias("bucket"), *columns)
    # the only shuffle of texts: all four uses below read it
    by_bucket = dealt.mapInArrow(tk.frugal(_pack), "bucket int not null, block binary not null").groupBy("bucket")

    anchors = by_bucket.applyInArrow(tk.frugal_group(_report_anchors(p)), "gram long not null, bucket int not null")
    shared = (
        anchors.withColumn("k", F.count("*").over(W.partitionBy("gram"))).filter("k > 1").select("bucket", "gram")
    )
    spans = by_bucket.cogroup(shared.groupBy("bucket")).applyInArrow(
        tk.frugal_groups(_report_spans(p)), "gram long not null, span long not null, bucket int not null, doc long not null"
    )
    # both uses of ``seen`` read the same columns and none is nullable, so no filter or pruning
    # tells their plans apart and Spark runs and shuffles the spans once
    seen = spans.repartition("gram").select(
        "*",
        F.min("doc").over(W.partitionBy("gram", "span")).alias("first"),
        F.min("span").over(W.partitionBy("gram")).alias("lo"),
        F.max("span").over(W.partitionBy("gram")).alias("hi"),
    )
    whole = seen.filter("first < doc").select(
        "bucket", "span", F.lit(0).alias("at"), F.lit(p.run).alias("n"), "first"
    )
    several = seen.filter("lo <> hi and first = doc")
    wanted = several.select("bucket", "span", "doc")
    raw = by_bucket.cogroup(wanted.groupBy("bucket")).applyInArrow(
        tk.frugal_groups(_report_bytes(p)), "gram long not null, span long not null, doc long not null, bytes binary not null"
    )
    counted = raw.repartition("gram").withColumn("k", F.count("*").over(W.partitionBy("gram")))
    few = counted.filter(F.col("k") <= p.spans_in_task).select("gram", "span", "doc", "bytes")
    resolved = few.repartition("gram").sortWithinPartitions("gram").mapInArrow(
        tk.frugal(_resolve(p)), "gram long, span long, at int, n int, first long"
    )
    many = counted.filter(F.col("k") > p.spans_in_task).select(
        "gram", "span", "doc", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - p.length)).alias("at")
    )
    many = many.select("gram", "span", "doc", "at", F.expr(f"substring(bytes, at + 1, {p.length})").alias("win"))
    least = many.groupBy("gram", "win").agg(F.min(F.struct("doc", "span"))["doc"].alias("first"))
    resolved_many = (
        many.join(least, ["gram", "win"]).filter("first < doc").select("gram", "span", "at", F.lit(1).alias("n"), "first")
    )
    partly = several.select("gram", "span", "bucket").join(resolved.unionByName(resolved_many), ["gram", "span"])
    replies = whole.unionByName(partly.select("bucket", "span", "at", "n", "first"))
    schema = _DIGEST
    if carry is not None:
        rest = dealt.schema["rest"].dataType.simpleString()
        schema += f", text string, rest {rest}"
    return by_bucket.cogroup(replies.groupBy("bucket")).applyInArrow(
        tk.frugal_groups(_cut(p, carry is not None)), schema
    )


def drop_repeats(docs: DataFrame, p: RepeatParams = PARAMS) -> DataFrame:
    """The documents, all columns, without their repeated passages (``n_chars`` follows)."""
    carry = [c for c in docs.columns if c != "text"]
    out = remove_repeats(docs, p, carry)
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("text"))
        elif c == "n_chars":
            cols.append(
                F.when(F.col("rest.n_chars").isNotNull(), F.coalesce(F.char_length("text"), F.lit(0)))
                .cast(docs.schema["n_chars"].dataType)
                .alias("n_chars")
            )
        else:
            cols.append(F.col(f"rest.`{c}`").alias(c))
    return out.select(*cols)
