"""Approximate nearest neighbours by inner product: a forest of sorted hash strings.

Every tree gives a vector a long string of sign bits of random hyperplanes and
is the sorted array of these strings; vectors with a common prefix of x bits
are one range of it.  A query descends in every tree and then all trees ascend
together: the longest common depth x at which the ranges hold ``share`` of all
vectors (counted over the trees) gives the candidates, which are scored by
their exact inner product.

Inner products are not angles, so vectors get a further coordinate before they
are hashed (queries get 0 there).  It brings them to the greatest length of
their norm band; bands are a factor of ``band`` wide, so a few long vectors do not
press all others to one side.

A tree is dealt into blocks by its first bits; an oversized block (many vectors
of nearly one direction) is split by a hash and its queries go to every part.
Equal vectors are one entry with their smallest ids, as many as a result can
show, so a vector that a third of all rows hold is one entry.

``share`` is fitted with ``sample_queries`` queries against all vectors: one pass
finds their nearest by brute force, how deep these share a prefix with the
query, and how many vectors do at every depth; the smallest share with which
the forest has ``aim`` recall is taken.  So it follows the table: with clusters of a
fixed size it falls as the table grows.

Defined results: vectors that are null, zero, or hold nulls or non-finite
components take no part, nor do vectors of another length than the commonest
(ties: the longer); a null id takes no part; a row is never its own candidate,
nor are other rows with the query's id; repeated rows are one; ties go to the
smaller id; with fewer candidates a query has fewer rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import written


@dataclass(frozen=True)
class ForestParams:
    trees: int = 16
    bits: int = 60
    top: int = 20
    seed: int = 11
    aim: float = 0.95
    #: greatest ratio of two lengths in a norm band
    band: float = 1.05
    #: queries that the share is fitted with; each meets every vector
    sample_queries: int = 256
    #: vectors of one block: what a task holds of a tree
    block: int = 16_384


PARAMS = ForestParams()
#: candidate counts, in vectors of the table, that the fit tries
_SHARES = tuple(2.0 ** (k / 2) for k in range(-40, 9))


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v: rows that take part."""
    double = isinstance(vectors.schema["embedding"].dataType.elementType, T.DoubleType)
    v = F.col("embedding").cast("array<double>" if double else "array<float>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(fine & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    return rows.filter(F.size("v") == (sizes["k"] if sizes else 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """rep, v, ids: each vector once with its ``keep`` smallest ids, rep the smallest."""
    by = W.partitionBy("v").orderBy("vec_id")
    few = rows.distinct().withColumn("r", F.row_number().over(by)).filter(F.col("r") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "v", "ids"
    )


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.float32()))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.float32)


def _planes(dim: int, p: ForestParams) -> np.ndarray:
    return np.random.default_rng(p.seed).standard_normal((dim + 1, p.trees * p.bits)).astype(np.float32)


def hash_strings(x: np.ndarray, longest: float, p: ForestParams, query: bool) -> np.ndarray:
    """Strings (vectors x trees) as integers, first bit highest."""
    planes = _planes(x.shape[1], p)
    signs = x @ planes[:-1]
    if not query:
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        steps = np.floor(np.log(np.maximum(1.0, longest / norm)) / np.log(p.band))
        more = np.sqrt(np.maximum(0.0, (longest * p.band**-steps) ** 2 - norm**2))
        signs += more[:, None].astype(np.float32) * planes[-1]
    bits = (signs > 0).reshape(len(x), p.trees, p.bits)
    return bits @ (np.int64(1) << np.arange(p.bits - 1, -1, -1, dtype=np.int64))


def prefix_ranges(sorted_: np.ndarray, strings: np.ndarray, depth: np.ndarray | int, bits: int):
    """Ranges of a sorted array that share the first ``depth`` bits with each string."""
    shift = np.asarray(bits - depth, dtype=np.int64)
    lo = (strings >> shift) << shift
    hi = lo + (np.int64(1) << shift) - 1
    return np.searchsorted(sorted_, lo, "left"), np.searchsorted(sorted_, hi, "right")


def _meet_all(reps: np.ndarray, asks: np.ndarray, longest: float, p: ForestParams):
    """A task's vectors against the sampled queries.

    Rows (ask, depth, n, null, null): vectors that share at least ``depth`` bits, over the trees;
    rows (ask, depth, null, rep, product): the nearest, with the deepest prefix that a tree shares.
    """
    strings = hash_strings(asks, longest, p, True)
    x = asks.astype(np.float64)

    def run(batches):
        counts = np.zeros((len(asks), p.bits + 1), dtype=np.int64)
        best = [np.zeros((len(asks), 0)), *(np.zeros((len(asks), 0), dtype=np.int64) for _ in range(2))]
        for batch in batches:
            if not len(batch):
                continue
            rep, v = batch.column(0).to_numpy(), _matrix(batch.column(1))
            index = hash_strings(v, longest, p, False)
            for t in range(p.trees):
                ordered = np.sort(index[:, t])
                for d in range(p.bits + 1):
                    lo, hi = prefix_ranges(ordered, strings[:, t], d, p.bits)
                    counts[:, d] += hi - lo
            products = x @ v.astype(np.float64).T
            products[reps[:, None] == rep[None, :]] = -np.inf
            some = np.argsort(-products, axis=1, kind="stable")[:, : p.top]
            common = np.zeros(some.shape, dtype=np.int64)
            for t in range(p.trees):
                differ = index[some, t] ^ strings[:, t][:, None]
                length = p.bits - np.where(differ > 0, np.floor(np.log2(np.maximum(1, differ))) + 1, 0)
                common = np.maximum(common, length.astype(np.int64))
            both = [np.concatenate(c, axis=1) for c in zip(best, (np.take_along_axis(products, some, 1), rep[some], common))]
            order = np.lexsort((both[1], -both[0]), axis=1)[:, : p.top]
            best = [np.take_along_axis(c, order, axis=1) for c in both]
        ask, depth = np.nonzero(counts)
        at, place = np.nonzero(best[0] > -np.inf)
        m, k = len(ask), len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((ask, at)).astype(np.int32)),
                pa.array(np.concatenate((depth, best[2][at, place])).astype(np.int32)),
                pa.array(np.concatenate((counts[ask, depth], np.zeros(k, np.int64))), mask=np.repeat([False, True], [m, k])),
                pa.array(np.concatenate((np.zeros(m, np.int64), best[1][at, place])), mask=np.repeat([True, False], [m, k])),
                pa.array(np.concatenate((np.zeros(m), best[0][at, place])), mask=np.repeat([True, False], [m, k])),
            ],
            names=["ask", "depth", "n", "rep", "product"],
        )

    return run


def fit_share(entries: DataFrame, n: int, longest: float, p: ForestParams) -> float:
    """Smallest share of candidates with which the forest over all entries has the aimed recall."""
    if n <= p.top + 1:
        return float(p.trees)
    rows = entries.select("rep", "v").orderBy(F.xxhash64("rep"), "rep").limit(p.sample_queries).toPandas()
    asks = np.stack(rows["v"].to_numpy())
    met = written(
        entries.select("rep", "v").mapInArrow(
            _meet_all(rows["rep"].to_numpy(), asks, longest, p), "ask int, depth int, n long, rep long, product double"
        ),
        "forest-fit",
    )
    counts = np.zeros((len(asks), p.bits + 1), dtype=np.int64)
    for ask, depth, total in met.filter("n is not null").groupBy("ask", "depth").agg(F.sum("n")).collect():
        counts[ask, depth] = total
    nearest = W.partitionBy("ask").orderBy(F.desc("product"), "rep")
    first = met.filter("rep is not null").withColumn("r", F.row_number().over(nearest)).filter(F.col("r") <= p.top)
    found = np.array(first.select("ask", "depth").collect(), dtype=np.int64).reshape(-1, 2)
    for share in _SHARES:
        enough = counts >= min(share, p.trees) * n
        depth = p.bits - np.argmax(enough[:, ::-1], axis=1)
        if (found[:, 1] >= depth[found[:, 0]]).mean() >= p.aim:
            return min(share, float(p.trees))
    return float(p.trees)


def _hash_batches(longest: float, p: ForestParams, query: bool):
    def run(batches):
        for batch in batches:
            strings = hash_strings(_matrix(batch.column(1)), longest, p, query) if len(batch) else np.zeros((0, p.trees))
            at = np.arange(len(batch) + 1, dtype=np.int32) * p.trees
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(strings.ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["rep", "v", "strings"])

    return run


def _strings(vectors: DataFrame, longest: float, p: ForestParams, query: bool) -> DataFrame:
    """rep, v, tree, string."""
    kind = vectors.schema["v"].dataType.simpleString()
    hashed = vectors.select("rep", "v").mapInArrow(
        _hash_batches(longest, p, query), f"rep long, v {kind}, strings array<long>"
    )
    return hashed.select("rep", "v", F.posexplode("strings").alias("tree", "string"))


def _count_ranges(p: ForestParams, first: int):
    """How many vectors of the block share each prefix with its queries, as long as there are several."""

    def run(index: pa.Table, asks: pa.Table) -> pa.Table:
        s = np.sort(index.column("string").to_numpy())
        strings, rep = asks.column("string").to_numpy(), asks.column("rep").to_numpy()
        out = []
        for d in range(first, p.bits + 1):
            if not len(strings):
                break
            lo, hi = prefix_ranges(s, strings, d, p.bits)
            n = hi - lo
            out.append((rep, np.full(len(rep), d, np.int32), n))
            go = n > 1
            strings, rep = strings[go], rep[go]
        rep, depth, n = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"rep": pa.array(rep), "depth": pa.array(depth, pa.int32()), "n": pa.array(n, pa.int64())})

    return run


def _score_ranges(p: ForestParams, keep: int):
    """The best ``keep`` vectors of each query's range in the block, ties to the smallest ``rep``."""

    def run(index: pa.Table, asks: pa.Table) -> pa.Table:
        strings = index.column("string").to_numpy()
        order = np.argsort(strings, kind="stable")
        strings, reps = strings[order], index.column("rep").to_numpy()[order]
        x = _matrix(index.column("v")).astype(np.float64)[order] if len(index) else np.zeros((0, 1))
        q, who = _matrix(asks.column("v")).astype(np.float64), asks.column("rep").to_numpy()
        longest, sizes = np.linalg.norm(x, axis=1), np.linalg.norm(q, axis=1)
        lo, hi = prefix_ranges(strings, asks.column("string").to_numpy(), asks.column("depth").to_numpy(), p.bits)
        out = []
        for a, b in np.unique(np.stack((lo, hi), axis=1), axis=0):
            if a == b:
                continue
            there = np.flatnonzero((lo == a) & (hi == b))
            for i in range(0, len(there), 256):  # queries of one range against its vectors
                k = there[i : i + 256]
                products = q[k] @ x[a:b].T
                m = min(keep, b - a)
                least = -np.partition(-products, m - 1, axis=1)[:, m - 1 : m]
                # all that tie with the last of them, but for what the products round
                room = 4 * x.shape[1] * np.finfo(float).eps * sizes[k][:, None] * longest[a:b].max()
                asked, best = np.nonzero(products >= least - room)
                best += a
                exact = np.empty(len(best))
                for j in range(0, len(best), 1 << 14):
                    part = slice(j, j + (1 << 14))
                    exact[part] = (q[k[asked[part]]] * x[best[part]]).sum(axis=1)
                order = np.lexsort((reps[best], -exact, asked))
                asked, best, exact = asked[order], best[order], exact[order]
                top = np.arange(len(asked)) - np.searchsorted(asked, asked) < keep
                out.append((who[k[asked[top]]], reps[best[top]], exact[top]))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64))
        a, b, c = (np.concatenate(z) for z in zip(*out, strict=True)) if out else empty
        return pa.table({"query": pa.array(a), "found": pa.array(b), "score": pa.array(c)})

    return run


def search(vectors: DataFrame, every: int, p: ForestParams = PARAMS) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors)
    entries = written(distinct_vectors(rows, p.top + 1), "forest-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    n, longest = entries.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = fit_share(entries, n, longest, p)
    queries = written(
        rows.filter(F.col("vec_id") % every == 0)
        .join(entries.select("rep", "v"), "v")
        .select(F.col("vec_id").alias("query_id"), "rep")
        .distinct(),
        "forest-queries",
    )
    first = max(0, int(np.ceil(np.log2(max(1.0, n / p.block)))))
    block = F.expr(f"shiftright(string, {p.bits - first})")
    index = _strings(entries, longest, p, False).withColumn("block", block)
    asked = entries.join(queries.select("rep").distinct(), "rep", "left_semi")
    asks = _strings(asked, longest, p, True).withColumn("block", block)

    # blocks of every tree and the parts of oversized ones
    blocks = written(
        index.groupBy("tree", "block").agg(F.count("*").alias("size")).withColumn("parts", F.ceil(F.col("size") / (2 * p.block))),
        "forest-blocks",
    )
    part = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts"))
    dealt = index.join(blocks, ["tree", "block"]).withColumn("part", part)
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    here = asks.join(blocks, ["tree", "block"]).withColumn("part", every_part)
    keys = ["tree", "block", "part"]
    deep = (
        dealt.select(*keys, "string")
        .groupBy(*keys)
        .cogroup(here.select(*keys, "rep", "string").groupBy(*keys))
        .applyInArrow(_count_ranges(p, first), "rep long, depth int, n long")
    )
    # prefixes shorter than the blocks': sums of block sizes
    depths = F.explode(F.sequence(F.lit(0), F.lit(max(0, first - 1))))
    up = lambda df: df.withColumn("depth", depths).withColumn(
        "prefix", F.expr(f"shiftright(block, {first} - depth)")
    )
    sums = up(blocks).groupBy("tree", "depth", "prefix").agg(F.sum("size").alias("n"))
    shallow = up(asks.select("rep", "tree", "block")).join(sums, ["tree", "depth", "prefix"]).select("rep", "depth", "n")
    counts = deep.unionByName(shallow) if first else deep
    enough = int(np.ceil(share * n))
    chosen = (
        counts.groupBy("rep", "depth")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= enough) | (F.col("depth") == 0))
        .groupBy("rep")
        .agg(F.max("depth").alias("depth"))
    )
    # a query goes to every block that its prefix covers
    span = F.expr(f"shiftleft(1L, greatest(0, {first} - depth))")
    begin = F.expr(f"shiftleft(shiftright(block, greatest(0, {first} - depth)), greatest(0, {first} - depth))")
    sent = (
        asks.join(chosen, "rep")
        .withColumn("block", F.explode(F.sequence(begin, begin + span - 1)))
        .join(blocks, ["tree", "block"])
        .withColumn("part", every_part)
    )
    keep = p.top + 1
    found = (
        dealt.select(*keys, "rep", "v", "string")
        .groupBy(*keys)
        .cogroup(sent.select(*keys, "rep", "v", "string", "depth").groupBy(*keys))
        .applyInArrow(_score_ranges(p, keep), "query long, found long, score double")
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "found")
    few = (
        found.groupBy("query", "found")
        .agg(F.max("score").alias("score"))
        .withColumn("r", F.row_number().over(best))
        .filter(F.col("r") <= keep)
    )
    # back to rows: every id of a found vector but the query's own
    named = (
        few.join(entries.select(F.col("rep").alias("found"), "ids"), "found")
        .join(queries.withColumnRenamed("rep", "query"), "query")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
    )
    last = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        named.withColumn("rank", F.row_number().over(last))
        .filter(F.col("rank") <= p.top)
        .select("query_id", "rank", "vec_id", "score")
    )
