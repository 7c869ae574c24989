"""Ranked lexical search by pipelined term partitioning.

Terms have owners: the bundle's terms are ordered by document frequency and cut
into stages of equal numbers of postings, rare terms first.  A bundle of items
travels through the owners.  What travels is a set of sparse accumulators, one
per item and block of documents; at each stage a cogroup by block brings them
together with the postings of the stage's terms, and integer contributions are
added.  After the last stage each block gives its best documents per item, and a
bounded top-k per item selects from these.

1. Documents are tokenised block by block (whole documents); the postings of the
   bundle's terms are written with every document's length, and so are counts
   that add up to N, L, and each term's document frequency and largest frequency.
2. From these follow the weights, the stages, and the most that the terms of
   later stages can add for each item.
3. An accumulator is dropped at a stage when its sum and all that later stages can
   add stay below ``keep`` documents' sums: those of its own block, and from the
   second stage on the best of all blocks.  In the same way documents without an
   accumulator get none once later terms alone cannot reach that sum.  Both are
   bounds, not estimates: no result is lost.

The items of a bundle and their terms are bounded (``bundle_items``,
``batch_terms``) and sent to the tasks with the code; more items make more bundles.

Scores are 64-bit integers; see ``weights`` and ``_parts``.  A word is found by its
64-bit hash and then compared byte by byte.

Defined results: null and empty texts have no terms and are never found; items
without terms find nothing; rows of one item id are one item with the terms of
all of them; documents that share a doc_id, repeated rows too, are documents of
their own; ties go to the smaller doc_id, null ids last; texts of any length are
read whole; an empty table on either side gives an empty result; columns other
than item_id, doc_id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass(frozen=True)
class SearchParams:
    #: documents of an item's result
    keep: int = 50
    #: owners of terms that a bundle passes through
    stages: int = 3
    #: documents and text bytes of a block (at least one document)
    block_docs: int = 8192
    block_bytes: int = 16 << 20
    #: items whose accumulators travel together
    bundle_items: int = 256
    #: (item, term) pairs of the bundles that share one tokenisation of the documents
    batch_terms: int = 1 << 18


# -- items -------------------------------------------------------------------------


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item, sorted."""
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))
    each = items.select(F.col("item_id").cast("long"), F.explode(found).alias("term"))
    return each.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def batches(items: DataFrame, p: SearchParams) -> Iterator[list[tuple]]:
    """Lists of (item_id, terms), each with at most ``batch_terms`` pairs, or one cell of items.

    Items are dealt into cells by a hash of the id; the driver sees the cells'
    sizes and then one batch at a time.
    """
    terms = written(item_terms(items), "item-terms")
    pairs = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    cells = max(1, -(-8 * pairs // p.batch_terms))
    cell = F.pmod(F.xxhash64("item_id"), F.lit(cells))
    sizes = {r[0]: r[1] for r in terms.groupBy(cell.alias("c")).agg(F.sum(F.size("terms"))).collect()}
    group: list[int] = []
    total = 0
    for c in [*sorted(sizes), None]:
        if group and (c is None or total + sizes[c] > p.batch_terms):
            rows = terms.filter(cell.between(group[0], group[-1])).collect()
            yield sorted(((r.item_id, r.terms) for r in rows), key=lambda x: (x[0] is None, x[0] or 0))
            group, total = [], 0
        if c is not None:
            group.append(c)
            total += sizes[c]


class Vocabulary:
    """Distinct terms of a batch: sorted hashes with the bytes of each."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        ends = np.cumsum(size)
        buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
        h = tk.span_hash(tk.prefix_hash(buf), ends - size, ends)
        order = np.argsort(h, kind="stable")
        self.hashes, self.buf = h[order], buf
        self.start, self.size = (ends - size)[order], size[order]
        #: position of each given term
        self.index = np.empty(len(terms), dtype=np.int64)
        self.index[order] = np.arange(len(terms))
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms of one hash")

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, buf: np.ndarray, run: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Term at each span of ``buf``, -1 where there is none."""
        h = tk.span_hash(run, s, e)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self) - 1)
        hit = np.flatnonzero((self.hashes[at] == h) & (self.size[at] == e - s))
        same = tk.equal_spans(buf, s[hit], self.buf, self.start[at[hit]], (e - s)[hit])
        out = np.full(len(s), -1, dtype=np.int64)
        out[hit[same]] = at[hit[same]]
        return out


# -- postings ----------------------------------------------------------------------

_zip = lambda a: zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=kind)


POSTINGS = (
    "block long, docs binary, none binary, sizes binary, terms binary, counts binary, who binary, times binary, "
    "term long, df long, most long"
)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def _post(v: Vocabulary, p: SearchParams):
    """Blocks of documents as postings, then the task's counts (rows without a block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        df, most = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        n_docs = n_terms = n_blocks = 0
        waiting: list[tuple] = []
        held = [0, 0]  # documents, bytes

        def block() -> pa.RecordBatch:
            nonlocal n_docs, n_terms, n_blocks
            ids = pa.concat_arrays([w[0] for w in waiting])
            sizes = np.concatenate([w[1] for w in waiting])
            shift = np.cumsum([0] + [len(w[1]) for w in waiting[:-1]])
            term = np.concatenate([w[2] for w in waiting])
            who = np.concatenate([w[3] + k for w, k in zip(waiting, shift, strict=True)]).astype(np.int32)
            times = np.concatenate([w[4] for w in waiting]).astype(np.int32)
            order = np.argsort(term, kind="stable")
            term, who, times = term[order], who[order], times[order]
            at = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
            counts = np.diff(np.concatenate((at, [len(term)])))
            if len(at):
                df[term[at]] += counts
                np.maximum.at(most, term, times)
            n_docs += int((sizes > 0).sum())
            n_terms += int(sizes.sum())
            row = [
                [first + n_blocks], [_zip(ids.fill_null(0).to_numpy())], [_zip(ids.is_null().to_numpy(zero_copy_only=False))],
                [_zip(sizes.astype(np.int32))], [_zip(term[at].astype(np.int32))], [_zip(counts.astype(np.int32))],
                [_zip(who)], [_zip(times)], [None], [None], [None],
            ]
            n_blocks += 1
            waiting.clear()
            held[:] = [0, 0]
            return _record(row)

        for b in batches:
            ids, text = b.column(0), b.column(1)
            for lo, hi, raw, off in tk.chunks(text):
                buf = tk.LOWER[raw]
                s, e, begin = tk.word_spans(buf, off, tk.NOT_ALNUM)
                sizes = np.diff(begin)
                term = v.find(buf, tk.prefix_hash(buf), s, e)
                doc = np.repeat(np.arange(hi - lo), sizes)
                known = term >= 0
                key, times = np.unique(term[known] * (hi - lo) + doc[known], return_counts=True)
                if waiting and (held[0] + hi - lo > p.block_docs or held[1] + len(raw) > p.block_bytes):
                    yield block()
                # a chunk of many short documents may be more than a block
                for k in range(0, hi - lo, p.block_docs):
                    n = min(p.block_docs, hi - lo - k)
                    own = (key % (hi - lo) >= k) & (key % (hi - lo) < k + n)
                    waiting.append((ids.slice(lo + k, n), sizes[k : k + n], key[own] // (hi - lo),
                                    key[own] % (hi - lo) - k, times[own]))
                    held[0] += n
                    if k + n < hi - lo:
                        yield block()
                held[1] += len(raw)
        if waiting:
            yield block()
        if n_docs:
            seen = np.flatnonzero(df)
            m = len(seen) + 1
            yield _record([[None] * m] * 8 + [[-1, *seen.tolist()], [n_docs, *df[seen].tolist()], [n_terms, *most[seen].tolist()]])

    return run


def _record(columns: list[list]) -> pa.RecordBatch:
    names = [c.strip().split(" ")[0] for c in POSTINGS.split(",")]
    kinds = [pa.int64() if c.strip().endswith("long") else pa.binary() for c in POSTINGS.split(",")]
    return pa.record_batch([_column(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


# -- scores ------------------------------------------------------------------------


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def _parts(times: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 20 * m)


@dataclass
class Plan:
    """What the owners need: the bundle's terms by stage and item, and bounds."""

    n_docs: int
    n_terms: int
    weight: np.ndarray
    stage: np.ndarray
    #: terms of each item, as positions in the vocabulary
    items: list[np.ndarray]
    #: the most that stages from s on can add, by stage and item
    ahead: np.ndarray
    keep: int
    least: np.ndarray | None = None

    @staticmethod
    def of(n_docs, n_terms, df, most, items, p: SearchParams) -> Plan:
        w = weights(n_docs, df)
        # a document of one term has the least m, 50
        bound = w * _parts(most, 50)
        order = np.argsort(df, kind="stable")
        before = np.cumsum(df[order]) - df[order]
        stage = np.empty(len(df), dtype=np.int64)
        stage[order] = before * p.stages // max(1, int(df.sum()))
        ahead = np.array([[int(bound[i][stage[i] >= s].sum()) for i in items] for s in range(p.stages + 1)])
        return Plan(n_docs, n_terms, w, stage, items, ahead.reshape(p.stages + 1, len(items)), p.keep)


ACCUMULATORS = "block long, docs binary, none binary, sizes binary, items binary, counts binary, who binary, sums binary"


def _add(plan: Plan, s: int, sizes, acc: dict, terms, at, who, times) -> dict:
    """Accumulators of a block after stage ``s``: item -> (documents, sums)."""
    m = 50 + (50 * sizes.astype(np.int64) * plan.n_docs) // plan.n_terms
    part = _parts(times.astype(np.int64), m[who])
    place = {int(t): k for k, t in enumerate(terms)}
    dense = np.zeros(len(sizes), dtype=np.int64)
    out = {}
    for i, own in enumerate(plan.items):
        least = 0 if plan.least is None else int(plan.least[i])
        docs, sums = acc.get(i, (None, None))
        here = [place[t] for t in own[plan.stage[own] == s].tolist() if t in place]
        if docs is None and not here:
            continue
        dense[:] = 0
        if docs is not None:
            dense[docs] = sums
        for k in here:
            span = slice(at[k], at[k + 1])
            dense[who[span]] += plan.weight[terms[k]] * part[span]
        # documents without a sum so far can only reach what this and later stages add
        if plan.ahead[s, i] >= least or docs is None:
            docs = np.flatnonzero(dense)
        sums = dense[docs]
        later = int(plan.ahead[s + 1, i])
        if len(sums) > plan.keep:
            least = max(least, int(np.partition(sums, -plan.keep)[-plan.keep]))
        stay = sums + later >= least
        if stay.any():
            out[i] = (docs[stay].astype(np.int32), sums[stay])
    return out


def _owner(plan: Plan, s: int):
    """The cogroup of stage ``s``: a block's accumulators and the postings of the stage's terms."""
    last = s == plan.ahead.shape[0] - 2

    def meet(carried: pa.Table, posted: pa.Table) -> pa.Table:
        row = {c: (carried if carried.num_rows else posted)[c][0].as_py() for c in ("block", "docs", "none", "sizes")}
        sizes = _unzip(row["sizes"], np.int32)
        acc = {}
        if carried.num_rows:
            x = carried.to_pylist()[0]
            items, counts = _unzip(x["items"], np.int32), _unzip(x["counts"], np.int32)
            who, sums, ends = _unzip(x["who"], np.int32), _unzip(x["sums"], np.int64), np.cumsum(counts)
            acc = {int(i): (who[e - n : e], sums[e - n : e]) for i, n, e in zip(items, counts, ends, strict=True)}
        terms = who = times = np.zeros(0, np.int32)
        at = np.zeros(1, np.int64)
        if posted.num_rows:
            x = posted.to_pylist()[0]
            terms, who, times = (_unzip(x[c], np.int32) for c in ("terms", "who", "times"))
            at = np.concatenate(([0], np.cumsum(_unzip(x["counts"], np.int32))))
        acc = _add(plan, s, sizes, acc, terms, at, who, times)
        return _best(row, acc, plan.keep) if last else _carry(row, acc)

    return meet


def _carry(row: dict, acc: dict) -> pa.Table:
    items = np.array(sorted(acc), dtype=np.int32)
    counts = np.array([len(acc[i][0]) for i in items.tolist()], dtype=np.int32)
    join = lambda k, kind: np.concatenate([np.zeros(0, kind), *(acc[i][k] for i in items.tolist())]).astype(kind)
    more = {"items": _zip(items), "counts": _zip(counts), "who": _zip(join(0, np.int32)), "sums": _zip(join(1, np.int64))}
    return pa.table(
        {k: pa.array([v], type=pa.int64() if k == "block" else pa.binary()) for k, v in {**row, **more}.items()}
    )


def _best(row: dict, acc: dict, keep: int) -> pa.Table:
    """The block's first ``keep`` documents of each item: item, doc_id, score."""
    ids, none = _unzip(row["docs"], np.int64), _unzip(row["none"], np.bool_)
    out = [[], [], []]
    for i, (docs, sums) in acc.items():
        docs, sums = docs[sums > 0], sums[sums > 0]
        order = np.lexsort((ids[docs], none[docs], -sums))[:keep]
        out[0].append(np.full(len(order), i, dtype=np.int32))
        out[1].append(docs[order])
        out[2].append(sums[order])
    item, docs, sums = (np.concatenate([np.zeros(0, k), *x]).astype(k) for x, k in zip(out, (np.int32, np.int64, np.int64), strict=True))
    return pa.table(
        {"item": pa.array(item), "doc_id": pa.array(ids[docs], mask=none[docs]), "score": pa.array(sums)}
    )


def _stage_postings(plan: Plan, wanted: np.ndarray, s: int):
    """Blocks with the postings of a stage's terms alone."""
    mine = wanted & (plan.stage == s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                terms, counts = _unzip(x["terms"], np.int32), _unzip(x["counts"], np.int32)
                own = mine[terms]
                if not own.any():
                    continue
                keep = np.repeat(own, counts)
                x |= {"terms": _zip(terms[own]), "counts": _zip(counts[own])}
                x |= {c: _zip(_unzip(x[c], np.int32)[keep]) for c in ("who", "times")}
                yield pa.record_batch(
                    [pa.array([v], type=pa.int64() if k == "block" else pa.binary()) for k, v in x.items()], names=list(x)
                )

    return run


def _sums_of_tasks(keep: int):
    """The best ``keep`` sums of each item in a task's accumulators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for b in batches:
            for x in b.to_pylist():
                counts, sums = _unzip(x["counts"], np.int32), _unzip(x["sums"], np.int64)
                for i, n, e in zip(_unzip(x["items"], np.int32).tolist(), counts, np.cumsum(counts), strict=True):
                    both = np.concatenate((best.get(i, sums[:0]), sums[e - n : e]))
                    best[i] = np.partition(both, -keep)[-keep:] if len(both) > keep else both
        for i, sums in best.items():
            yield pa.record_batch([pa.array(np.full(len(sums), i, np.int32)), pa.array(sums)], names=["item", "sum"])

    return run


def _least(acc: DataFrame, n_items: int, keep: int) -> np.ndarray:
    """Each item's ``keep``-th best sum so far; 0 where there are fewer."""
    sums = acc.select("items", "counts", "sums").mapInArrow(tk.frugal(_sums_of_tasks(keep)), "item int, sum long")
    w = Window.partitionBy("item").orderBy(F.col("sum").desc())
    out = np.zeros(n_items, dtype=np.int64)
    for r in sums.withColumn("at", F.row_number().over(w)).filter(F.col("at") == keep).collect():
        out[r.item] = r["sum"]
    return out


# -- the search --------------------------------------------------------------------


def _travel(blocks: DataFrame, plan: Plan, p: SearchParams) -> DataFrame:
    """A bundle through all owners: item, doc_id, score of every block's best documents."""
    wanted = np.zeros(len(plan.stage), dtype=bool)
    wanted[np.concatenate(plan.items)] = True
    columns = ["block", "docs", "none", "sizes", "terms", "counts", "who", "times"]
    schema = ", ".join(POSTINGS.split(", ")[:8])
    empty = blocks.sparkSession.createDataFrame([], ACCUMULATORS)
    acc = empty
    for s in range(p.stages):
        posted = blocks.select(*columns).mapInArrow(tk.frugal(_stage_postings(plan, wanted, s)), schema)
        last = s == p.stages - 1
        met = acc.groupBy("block").cogroup(posted.groupBy("block")).applyInArrow(
            tk.frugal_groups(_owner(plan, s)), "item int, doc_id long, score long" if last else ACCUMULATORS
        )
        if last:
            return met
        acc = written(met, f"accumulators-{s}")
        plan = replace(plan, least=_least(acc, len(plan.items), p.keep))


def search(items: DataFrame, docs: DataFrame, p: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``keep`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = []
    for batch in batches(items, p):
        names = sorted({t for _, terms in batch for t in terms})
        v = Vocabulary(names)
        at = dict(zip(names, v.index.tolist(), strict=True))
        posted = written(texts.mapInArrow(tk.frugal(_post(v, p)), POSTINGS), "postings")
        counts = posted.filter("block is null").groupBy("term").agg(F.sum("df"), F.max("most"), F.sum("most")).collect()
        df, most, total = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64), (0, 0)
        for term, n, largest, summed in counts:
            if term < 0:
                total = (n, summed)
            else:
                df[term], most[term] = n, largest
        if not total[0]:
            continue
        blocks = posted.filter("block is not null")
        for k in range(0, len(batch), p.bundle_items):
            bundle = batch[k : k + p.bundle_items]
            own = [np.array(sorted(at[t] for t in terms), dtype=np.int64) for _, terms in bundle]
            found = _travel(blocks, Plan.of(*total, df, most, own, p), p)
            ids = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(bundle)], "item int, item_id long")
            best = _select(found, "item", p.keep).join(F.broadcast(ids), "item").select(
                "item_id", "rank", "doc_id", "score"
            )
            out.append(best)
    if len(out) > 1:  # bundles are done one after the other
        out = [written(x, "bundle-result") for x in out]
    result = spark.createDataFrame([], RESULT)
    for x in out:
        result = x if len(out) == 1 else result.unionByName(x)
    return result


def _select(found: DataFrame, item: str, keep: int) -> DataFrame:
    w = Window.partitionBy(item).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= keep)

