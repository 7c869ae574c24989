"""Approximate neighbours of item vectors: an LSH join with measured recall and work.

Vectors are scaled to unit length, so the nearest by cosine are the nearest by
distance, and centred, so that hyperplanes through the origin halve them.  A
table gives each vector a string of bits, the sides of random hyperplanes.  Its
leaves are the shortest prefixes that at most ``leaf`` vectors share: dense
regions get long prefixes, sparse ones short.  Vectors of one leaf are compared
with each other by one matrix product.  Vectors travel once per table, to the cell
of a short prefix, which finds its leaves itself; cells of too many are cut by counts.

Tables are added, twice as many each time, until a sample of queries, compared
with all vectors exactly, has the wanted recall; after ``max_tables`` leaves
become larger.  The result tells how many comparisons each item took.

Equal vectors are one entry with the smallest ids.  A leaf that all bits do not
split holds vectors that no projection tells apart; it is dealt into parts by a
hash.  Null, zero and non-finite vectors take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.factors import dot
from quire.session import written


@dataclass(frozen=True)
class LshParams:
    #: neighbours of an item
    k: int = 10
    #: vectors of a leaf at most
    leaf: int = 128
    #: tables at first and at most, bits of a table
    tables: int = 4
    max_tables: int = 32
    bits: int = 48
    #: recall to reach on the sample, and its queries
    recall: float = 0.95
    sample: int = 200
    seed: int = 11


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, unit) of the vectors that have a direction."""
    v = F.col(vector_col)
    norm = F.sqrt(dot(v, v))
    with_norm = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), norm.alias("n"))
    usable = F.col("n").isNotNull() & ~F.isnan("n") & (F.col("n") > 0) & (F.col("n") < float("inf"))
    return with_norm.where(usable).select(
        "id", F.transform("v", lambda x: x.cast("double") / F.col("n")).alias("unit")
    )


def entries(units: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: rep (smallest id), unit, firsts (the k + 1 smallest ids)."""
    w = Window.partitionBy("unit").orderBy("id")
    few = units.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1)
    return few.groupBy("unit").agg(F.sort_array(F.collect_list("id")).alias("firsts")).select(
        F.col("firsts")[0].alias("rep"), "unit", "firsts"
    )


def _mean(points: DataFrame) -> np.ndarray:
    size = points.select(F.size("unit")).first()[0]
    return np.array(points.agg(*[F.avg(F.col("unit")[i]) for i in range(size)]).first(), dtype=float)


def _codes(p: LshParams, first: int, last: int, mean: np.ndarray, more: int = 0):
    """Bit strings of the tables first..last - 1, one row per vector and table, with the ``more`` first columns after rep."""
    planes = np.random.default_rng(p.seed).normal(size=(p.max_tables, p.bits, len(mean)))[first:last]
    weight = 1 << np.arange(p.bits, dtype=np.int64)[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1) - mean
            for t in range(len(planes)):
                code = (x @ planes[t].T > 0) @ weight
                table = pa.array(np.full(b.num_rows, first + t, dtype=np.int32))
                yield pa.record_batch(
                    [b.column(0), table, pa.array(code), *b.columns[1 : 1 + more]], names=["rep", "tab", "code", *b.schema.names[1 : 1 + more]]
                )

    return run


#: levels that all strings are counted at; dense regions go on below
NEAR_LEVELS = 8
#: vectors that a cell, a task's group, has at most, in leaves
CELL_LEAVES = 64


def _first_level(p: LshParams, n: int) -> int:
    """The shortest prefix that may be a leaf."""
    return max(0, int(np.log2(max(1, n / p.leaf))) - 3)


def _leaves(codes: DataFrame, p: LshParams, n: int) -> DataFrame:
    """(tab, code, level, parts): the prefix length of each string's leaf.

    Strings are counted at ``NEAR_LEVELS`` levels, and those without a leaf there at
    all the others.  They have a row per level, which estimates of a plan's size do
    not see, so the joins are told not to broadcast.
    """
    start = _first_level(p, n)
    end = min(start + NEAR_LEVELS - 1, p.bits)
    counts = codes.groupBy("tab", "code").agg(F.count("*").alias("c"))
    leaves = _leaves_between(counts, p, start, end)
    if end < p.bits:
        rest = counts.hint("merge").join(leaves, ["tab", "code"], "left_anti")
        leaves = leaves.unionByName(_leaves_between(rest, p, end + 1, p.bits))
    return leaves


def _leaves_between(counts: DataFrame, p: LshParams, first: int, last: int) -> DataFrame:
    """The leaves at the levels first..last of strings (tab, code, c) that are in no leaf above.

    Strings of one prefix are all among ``counts`` or none of them is.
    """
    levels = F.sequence(F.lit(first), F.lit(last))
    each = counts.select("tab", "code", "c", F.explode(levels).alias("level"))
    prefix = F.expr(f"shiftright(code, {p.bits} - level)")
    sums = each.groupBy("tab", "level", prefix.alias("prefix")).agg(F.sum("c").alias("members"))
    fits = (F.col("members") <= p.leaf) | (F.col("level") == p.bits)
    found = each.select("tab", "code", "level", prefix.alias("prefix")).hint("merge").join(
        sums.where(fits), ["tab", "level", "prefix"]
    )
    # the shortest, with its members in the low bits: one long is aggregated by hash
    best = found.groupBy("tab", "code").agg(F.min(F.shiftleft(F.col("level").cast("long"), 48) + F.col("members")).alias("b"))
    members = F.col("b").bitwiseAND(F.lit((1 << 48) - 1))
    return best.select(
        "tab", "code", F.shiftright("b", 48).cast("int").alias("level"), F.ceil(members / p.leaf).cast("int").alias("parts")
    )


def _best(ids: np.ndarray, x: np.ndarray, k: int, tab: int) -> pa.Table:
    """The k best of each vector of a leaf, and a row with the comparisons it took."""
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    m = len(ids)
    n = min(k, m - 1)
    # ids ascend: a stable order breaks ties to the smaller id
    best = np.argsort(-score, axis=1, kind="stable")[:, :n]
    return pa.table({
        "id": np.concatenate((np.repeat(ids, n), ids)),
        "other": pa.array(np.concatenate((ids[best].ravel(), ids)), mask=np.repeat([False, True], [m * n, m])),
        "cosine": np.concatenate((np.take_along_axis(score, best, axis=1).ravel(), np.zeros(m))),
        "tab": np.full(m * (n + 1), tab, dtype=np.int32),
        "work": np.repeat([0, m - 1], [m * n, m]),
    })


def _columns(group: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    ids = group["rep"].to_numpy()
    return ids, group["unit"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1), group["tab"][0].as_py()


def _compare(k: int):
    """A group that is a leaf."""

    def leaf(group: pa.Table) -> pa.Table:
        ids, x, tab = _columns(group)
        return _best(ids, x, k, tab)

    return leaf


def leaf_runs(code: np.ndarray, start: int, p: LshParams) -> tuple[np.ndarray, np.ndarray]:
    """The order of a cell's strings, and where its leaves begin in it; see ``_leaves``."""
    order = np.argsort(code, kind="stable")
    c = code[order]
    ends, waiting = [], [(0, len(c), start)]
    while waiting:
        lo, hi, level = waiting.pop()
        if hi - lo <= p.leaf or level == p.bits:
            ends.append(lo)
            continue
        # a run is halved at the next bit; one half may be empty
        bit = p.bits - level - 1
        middle = lo + int(np.searchsorted((c[lo:hi] >> bit) & 1, 1))
        waiting += [(a, b, level + 1) for a, b in ((lo, middle), (middle, hi)) if b > a]
    return order, np.sort(np.array(ends, dtype=np.int64))


def _compare_cell(p: LshParams, start: int):
    """A group that has all vectors of one prefix: its leaves, one after the other."""

    def cell(group: pa.Table) -> pa.Table:
        ids, x, tab = _columns(group)
        hashes = group["hash"].to_numpy()
        order, begins = leaf_runs(group["code"].to_numpy(), start, p)
        out = []
        for run in np.split(order, begins[1:]):
            parts = -(-len(run) // p.leaf)
            part = hashes[run] % parts
            out += [_best(ids[at], x[at], p.k, tab) for j in range(parts) if len(at := run[part == j])]
        return pa.concat_tables(out)

    return cell


FOUND = "id long, other long, cosine double, tab int, work long"


def table_pairs(points: DataFrame, p: LshParams, first: int, last: int, mean: np.ndarray, n: int) -> DataFrame:
    """What the tables first..last - 1 find: (id, other, cosine, tab), and (id, null, tab, work) rows."""
    start = _first_level(p, n)
    cell = F.expr(f"shiftright(code, {p.bits - start})").alias("cell")
    strings = lambda: points.select("rep", "unit").mapInArrow(_codes(p, first, last, mean), "rep long, tab int, code long")
    sizes = strings().groupBy("tab", cell).agg(F.count("*").alias("c"))
    crowded = written(sizes.where(F.col("c") > CELL_LEAVES * p.leaf).select("tab", "cell"), "lsh-crowded")
    hashed = points.select("rep", "unit", F.xxhash64("rep").alias("hash"))
    placed = hashed.mapInArrow(_codes(p, first, last, mean, 2), "rep long, tab int, code long, unit array<double>, hash long")
    placed = placed.select("*", cell)
    if crowded.isEmpty():
        return placed.groupBy("tab", "cell").applyInArrow(_compare_cell(p, start), FOUND)
    # a crowded cell has thousands of vectors: they are few, whatever the table's size
    few = placed.join(F.broadcast(crowded), ["tab", "cell"], "left_anti")
    near = few.groupBy("tab", "cell").applyInArrow(_compare_cell(p, start), FOUND)
    many = strings().select("*", cell).join(F.broadcast(crowded), ["tab", "cell"], "left_semi").drop("cell")
    return near.unionByName(_crowded_pairs(points, written(many, "lsh-codes"), p, n))


def _crowded_pairs(points: DataFrame, codes: DataFrame, p: LshParams, n: int) -> DataFrame:
    """As ``table_pairs``, of strings whose prefixes may have any number of members."""
    leaves = _leaves(codes, p, n)
    prefix = F.expr(f"shiftright(code, {p.bits} - level)").alias("prefix")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")
    placed = codes.hint("merge").join(leaves, ["tab", "code"]).select("rep", "tab", "level", prefix, part)
    members = placed.hint("merge").join(points.select("rep", "unit"), "rep")
    return members.groupBy("tab", "level", "prefix", "part").applyInArrow(_compare(p.k), FOUND)


def exact_neighbours(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(id, other, cosine) of the k nearest of each query, against all points; the queries must be few."""
    rows = queries.select("rep", "unit").collect()
    ids = np.array([r.rep for r in rows], dtype=np.int64)
    q = np.array([r.unit for r in rows], dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            other = b.column(0).to_numpy()
            score = q @ b.column(1).flatten().to_numpy().reshape(b.num_rows, -1).T
            score[ids[:, None] == other[None, :]] = -np.inf
            order = np.lexsort((np.broadcast_to(other, score.shape), -score))[:, :k]
            best = np.take_along_axis(score, order, axis=1)
            real = best.ravel() > -np.inf
            yield pa.record_batch(
                [pa.array(np.repeat(ids, order.shape[1])[real]), pa.array(other[order].ravel()[real]),
                 pa.array(best.ravel()[real])],
                names=["id", "other", "cosine"],
            )

    near = points.select("rep", "unit").mapInArrow(run, "id long, other long, cosine double")
    return _top(near, k)


def _top(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.col("cosine").desc(), "other")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _sample(points: DataFrame, p: LshParams, n: int) -> DataFrame:
    """About ``sample`` points by a hash, at most twice as many."""
    share = max(1, n // p.sample)
    return points.where(F.pmod(F.xxhash64("rep", F.lit(p.seed)), F.lit(share)) == 0).limit(2 * p.sample)


def recall_curve(found: DataFrame, exact: DataFrame, tables: list[int], n: int) -> DataFrame:
    """One row per number of tables: recall of the exact pairs, mean share of all vectors compared with.

    A pair that is compared in a table is among its leaf's best if it is among
    the best of all, so the first table that finds it tells the curve.
    """
    steps = F.array(*[F.lit(t) for t in tables])
    # the sample's pairs are few: the others are not shuffled
    asked = F.broadcast(exact.select("id", "other"))
    first = found.where(F.col("other").isNotNull()).join(asked, ["id", "other"]).groupBy("id", "other").agg(
        F.min("tab").alias("first")
    )
    hits = exact.join(first, ["id", "other"], "left").select(F.explode(steps).alias("tables"), "first")
    recall = hits.groupBy("tables").agg(F.avg((F.coalesce(F.col("first") < F.col("tables"), F.lit(False))).cast("double")).alias("recall"))
    # a vector has one row of work in each table
    work = found.where(F.col("other").isNull()).groupBy("tab").agg(F.sum("work").alias("work"), F.count("*").alias("ids"))
    share = work.select("*", F.explode(steps).alias("tables")).where(F.col("tab") < F.col("tables")).groupBy("tables").agg(
        (F.sum("work") / F.max("ids") / F.lit(float(max(1, n - 1)))).alias("examined")
    )
    return recall.join(share, "tables")


@dataclass(frozen=True)
class Search:
    """Neighbours with the tables that found them, and how they were measured."""

    points: DataFrame
    found: DataFrame
    exact: DataFrame
    params: LshParams
    tables: int
    n: int

    def curve(self) -> DataFrame:
        steps = [t for t in (1, 2, 4, 8, 16, 32, 64) if t < self.tables]
        return recall_curve(self.found, self.exact, [*steps, self.tables], self.n)


def search(vectors: DataFrame, id_col: str, vector_col: str, p: LshParams = LshParams()) -> Search:
    """Tables until the sample's recall is reached; larger leaves where the tables do not suffice."""
    points = written(entries(unit_vectors(vectors, id_col, vector_col), p.k), "lsh-points")
    n = points.count()
    if n == 0:
        none = points.sparkSession.createDataFrame([], FOUND)
        return Search(points, none, none.select("id", "other", "cosine"), p, 0, 0)
    mean = _mean(points)
    exact = written(exact_neighbours(points, _sample(points, p, n), p.k), "lsh-exact")
    while True:
        found, done, last = None, 0, min(p.tables, p.max_tables)
        while True:
            more = written(table_pairs(points, p, done, last, mean, n), "lsh-found")
            found = more if found is None else found.unionByName(more)
            row = recall_curve(found, exact, [last], n).first()
            if row is None or row.recall >= p.recall:
                return Search(points, found, exact, p, last, n)
            if last == p.max_tables:
                break
            done, last = last, min(2 * last, p.max_tables)
        if p.leaf >= n:  # one leaf was all there is
            return Search(points, found, exact, p, last, n)
        p = replace(p, leaf=4 * p.leaf)


def neighbours(vectors: DataFrame, s: Search, id_col: str, vector_col: str) -> DataFrame:
    """(id, rank, neighbour, cosine, examined): the k nearest found of every vector, ties to the smaller id."""
    k, kind = s.params.k, vectors.schema[id_col].dataType
    # one exchange, by id, serves the deduplication and the ranks
    pairs = s.found.where(F.col("other").isNotNull()).select("id", "other", "cosine").repartition("id").groupBy("id", "other").agg(
        F.max("cosine").alias("cosine")
    )
    best = _top(pairs, k).drop("rank")
    own = s.points.select(F.col("rep").alias("id"), F.col("rep").alias("other"), F.lit(1.0).alias("cosine"))
    firsts = s.points.select(F.col("rep").alias("other"), "firsts")
    near = best.unionByName(own).join(firsts, "other").select("id", "cosine", F.explode("firsts").alias("neighbour"))
    work = s.found.where(F.col("other").isNull()).groupBy("id").agg(F.sum("work").alias("examined"))
    # every vector has its entry's candidates, at most (k + 1) * (k + 1) of them
    members = unit_vectors(vectors, id_col, vector_col).join(
        s.points.select("unit", F.col("rep").alias("_rep")), "unit"
    ).select(F.col("id").alias("_id"), "_rep")
    every = members.join(near, members["_rep"] == near["id"]).where(F.col("_id") != F.col("neighbour"))
    w = Window.partitionBy("_id").orderBy(F.col("cosine").desc(), "neighbour")
    ranked = every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(work.withColumnRenamed("id", "_w"), F.col("_rep") == F.col("_w"), "left").select(
        F.col("_id").cast(kind).alias(id_col), "rank", F.col("neighbour").cast(kind).alias("neighbour"), "cosine",
        F.coalesce("examined", F.lit(0)).alias("examined"),
    )
