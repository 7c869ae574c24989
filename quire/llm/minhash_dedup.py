"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

Sketch: every element of a shingle set is thrown, round after round, into one
of t bins with a random value; in the first t rounds the bin is hashed, in the
next t rounds round t + i throws into bin i, so every bin is filled after 2t
rounds at the latest and usually after a few.  A bin keeps the least (round,
value).  Two sets agree in a bin with probability equal to their Jaccard
similarity, with the concentration of t nearly independent draws.

Bands of the sketch give buckets.  Documents with the same set form a class
first, and only its smallest doc_id goes on.  Instead of all pairs of a bucket,
the bucket's members are compared with its most central member (the one whose
buckets are largest); confirmed links are closed into components.  What is then
left, buckets with several components, goes on by an exact bound: a document
whose shingles are too often found in no other candidate cannot reach the
threshold with anyone.  The survivors are compared once more with a centre; the
rest meet across components at the shingles that few of them hold, where a
linked pair must meet (``prefix_pairs``).  No bucket is joined with itself, and
no candidate link is given up.

Defined results: null or wordless texts have an empty set and are linked with
nothing; a null doc_id has no component (null) and is kept; rows that share a
doc_id are one document with several texts; texts of any length are read whole;
an empty table gives an empty result; only ``doc_id`` and ``text`` are looked at,
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import written


@dataclass(frozen=True)
class NearDupParams:
    shingle: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6
    seed: int = 1

    @property
    def bins(self) -> int:
        return self.bands * self.rows


PARAMS = NearDupParams()


def fast_sketch(elements: np.ndarray, first: np.ndarray, bins: int, seed: int) -> np.ndarray:
    """Sketches (documents x bins) of concatenated element sets; ``first`` says where each begins."""
    n = len(first) - 1
    sizes = np.diff(first)
    most = np.iinfo(np.uint64).max
    out = np.full(n * bins, most, dtype=np.uint64)
    doc = np.repeat(np.arange(n), sizes)
    rng = np.random.default_rng(seed)
    salts = rng.integers(0, 1 << 63, size=2 * bins, dtype=np.uint64)
    low = np.uint64((1 << 52) - 1)
    live, x = sizes > 0, elements
    for r in range(2 * bins):
        if not len(x):
            break
        h = tk.mix(x ^ salts[r])
        if r < bins:
            bin_ = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
            value = (tk.mix(h) & low) | (np.uint64(r) << np.uint64(52))
        else:
            bin_ = r - bins
            value = (h & low) | (np.uint64(r) << np.uint64(52))
        np.minimum.at(out, doc * bins + bin_, value)
        at = np.flatnonzero(live)
        full = at[(out.reshape(n, bins)[at] != most).all(axis=1)]
        if len(full):
            live[full] = False
            go = live[doc]
            x, doc = x[go], doc[go]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cube = sketch.reshape(len(sketch), bands, rows)
    keys = tk.combine([cube[:, :, k].ravel() for k in range(rows)])
    tag = np.tile(np.arange(1, bands + 1, dtype=np.uint64), len(sketch))
    return tk.mix(keys ^ (tag << np.uint64(40))).reshape(len(sketch), bands)


def _sketch_batches(p: NearDupParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, starts in tk.chunks(batch.column(1)):
                words, first = tk.word_hashes(tk.LOWER[buf], starts)
                sets, at = tk.shingle_sets(words, first, p.shingle)
                n = np.diff(at)
                sums = []
                for salt in (3, 5):
                    run_ = np.concatenate(([np.uint64(0)], np.cumsum(tk.mix(sets + np.uint64(salt)), dtype=np.uint64)))
                    sums.append((run_[at[1:]] - run_[at[:-1]]).view(np.int64))
                keys = band_keys(fast_sketch(sets, at, p.bins, p.seed), p.bands, p.rows).view(np.int64)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), p.bands).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), keys],
                    names=["doc_id", "n_shingles", "set1", "set2", "bands"],
                )

    return run


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, starts in tk.chunks(batch.column(1)):
                words, first = tk.word_hashes(tk.LOWER[buf], starts)
                sets, at = tk.shingle_sets(words, first, size)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=["doc", "shingles"])

    return run


def sketches(docs: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set (set1, set2) and the band keys of every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tk.frugal(_sketch_batches(p)), "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>"
    )


def shingle_table(docs: DataFrame, wanted: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """doc, shingles: full shingle sets of the documents in ``wanted`` (column doc)."""
    some = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string"))
    return some.join(wanted.select("doc").distinct(), "doc", "left_semi").mapInArrow(
        tk.frugal(_set_batches(p.shingle)), "doc long, shingles array<long>"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("i")
    return (
        both.select("a", "b", "sa", "sb", inter.alias("i"))
        .filter((F.col("i") > 0) & (100 * F.col("i") >= p.percent * union))
        .select("a", "b")
        .distinct()
    )


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """v, c: each linked vertex and the smallest vertex it reaches.

    Least labels over neighbours with a shortcut (label of the label) per round;
    every round is written to the shared folder, the driver sees one flag.
    """
    both = links.select(F.col("a").alias("v"), F.col("b").alias("w"))
    both = written(both.union(both.select(F.col("w").alias("v"), F.col("v").alias("w"))), f"{name}-edges")
    labels = written(both.groupBy("v").agg(F.least("v", F.min("w")).alias("c")), f"{name}-labels")
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("w"), F.col("c").alias("cw")), "w")
            .groupBy("v")
            .agg(F.min("cw").alias("m"))
        )
        step = labels.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("cc"))
        new = written(
            step.join(jump, "c", "left").select("v", "old", F.coalesce("cc", "c").alias("c")), f"{name}-labels"
        )
        labels = new.select("v", "c")
        if new.filter("c <> old").isEmpty():
            return labels


def _centres(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each member of a bucket with the bucket's most central member."""
    size = members.groupBy("bucket").agg(F.count("*").alias("size"))
    central = members.join(size, "bucket").groupBy("doc").agg(F.sum("size").alias("weight"))
    best = (
        members.join(central, "doc")
        .groupBy("bucket")
        .agg(F.max(F.struct("weight", (-F.col("doc")).alias("neg"), "n", "comp")).alias("x"))
        .select(
            "bucket", (-F.col("x.neg")).alias("hub"), F.col("x.n").alias("hub_n"), F.col("x.comp").alias("hub_comp")
        )
    )
    return (
        members.join(best, "bucket")
        .filter(F.col("comp") != F.col("hub_comp"))
        .select(F.col("doc").alias("a"), F.col("hub").alias("b"), "n", "hub_n")
    )


def _size_fits(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def find_components(docs: DataFrame, p: NearDupParams = PARAMS) -> tuple[DataFrame, DataFrame]:
    """(rows, comps): rows have doc_id, n_shingles, rep; comps have v, c for linked representatives."""
    sk = written(sketches(docs, p), "neardup-sketches")
    full = sk.filter("n_shingles > 0 and doc_id is not null")
    keys = ["set1", "set2", "n_shingles"]
    classes = full.groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    rows = written(
        sk.select("doc_id", *keys)
        .join(classes, keys, "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")),
        "neardup-rows",
    )
    one = full.join(classes, keys).filter("doc_id = rep").dropDuplicates(["doc_id", *keys])
    banded = one.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi")
    members = written(
        banded.join(shared.select("bucket"), "bucket").select("bucket", "doc", "n", F.col("doc").alias("comp")),
        "neardup-members",
    )
    sets = written(shingle_table(docs, members, p), "neardup-sets")

    # copies of one text under several ids, and several texts under one id
    links = rows.filter("rep is not null and doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    several = rows.filter("rep is not null").groupBy("doc_id").agg(F.count_distinct("rep").alias("k")).filter("k > 1")
    tied = links.join(several.select(F.col("doc_id").alias("a")), "a", "left_semi").distinct()

    pairs = _centres(members).filter(_size_fits("n", "hub_n", p.percent)).select("a", "b").distinct()
    found = written(confirmed(pairs, sets, p).unionByName(tied), "neardup-links")
    comps = components(found, "neardup-1")

    # buckets that still hold several components: new centres, then every pair that full sets can link
    for last in (False, True):
        open_ = _open_members(members, comps, sets, p)
        if last:
            pairs = prefix_pairs(open_.select("doc", "comp").distinct(), sets, p)
        else:
            pairs = _centres(open_).filter(_size_fits("n", "hub_n", p.percent)).select("a", "b").distinct()
        more = written(confirmed(pairs, sets, p), "neardup-links")
        if more.isEmpty():
            continue
        found = found.unionByName(more)
        comps = components(found, f"neardup-{3 if last else 2}")
    return rows, comps


def prefix_pairs(open_: DataFrame, sets: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """Pairs (a, b) of these documents (doc, comp) that may reach the threshold; exact.

    Each document's shingles are put in one order, those that few of the documents
    hold first.  Linked sets have at least percent / 100 of either size in
    common, so each holds one of the common shingles among its first n - that + 1:
    documents meet at these alone, not in their buckets.  What two documents of
    different fields in one template share stands late in the order, where nothing
    meets.  At the first shingle that a linked pair has in common enough must
    be left on both sides; pairs that meet elsewhere only are no links.
    """
    each = sets.select("doc", F.xxhash64("shingles").alias("set"), F.size("shingles").alias("n"), "shingles")
    held = each.join(open_, "doc").select("doc", "set", "n", "comp", F.explode("shingles").alias("s"))
    counts = held.groupBy("s").agg(F.count("*").alias("df"))
    order = Window.partitionBy("doc", "set").orderBy("df", "s")
    least = F.ceil(F.col("n") * p.percent / 100)
    placed = held.join(counts, "s").withColumn("at", F.row_number().over(order))
    first = written(
        placed.filter((F.col("at") <= F.col("n") - least + 1) & (F.col("df") > 1)).select("s", "doc", "n", "comp", "at"),
        "neardup-prefixes",
    )
    side = lambda x: first.select("s", *[F.col(c).alias(f"{x}_{c}") for c in ("doc", "n", "comp", "at")])
    left = 1 + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    met = side("x").join(side("y"), "s").filter(
        (F.col("x_doc") < F.col("y_doc"))
        & (F.col("x_comp") != F.col("y_comp"))
        & _size_fits("x_n", "y_n", p.percent)
        & ((100 + p.percent) * left >= p.percent * (F.col("x_n") + F.col("y_n")))
    )
    return met.select(F.col("x_doc").alias("a"), F.col("y_doc").alias("b")).distinct()


def _open_members(members: DataFrame, comps: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """Members of buckets with several components that may still have a link there (written)."""
    now = (
        members.drop("comp")
        .join(comps.select(F.col("v").alias("doc"), "c"), "doc", "left")
        .select("bucket", "doc", "n", F.coalesce("c", "doc").alias("comp"))
    )
    mixed = (
        now.groupBy("bucket")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least_n"))
        .filter("lo < hi")
        .select("bucket", "least_n")
    )
    there = written(now.join(mixed, "bucket"), "neardup-open")
    # shingles that no other of these documents has: their owner is the minimum
    own = (
        sets.join(there.select("doc").distinct(), "doc", "left_semi")
        .select("doc", F.explode("shingles").alias("s"))
        .groupBy("s")
        .agg(F.min("doc").alias("doc"), F.max("doc").alias("hi"))
        .filter("doc = hi")
        .groupBy("doc")
        .agg(F.count("*").alias("alone"))
    )
    shared = F.col("n") - F.coalesce("alone", F.lit(0))
    # an intersection of two linked sets has at least percent / (100 + percent) of both sizes
    partner = F.greatest(F.col("least_n"), F.ceil(F.col("n") * p.percent / 100))
    alive = there.join(own, "doc", "left").filter((100 + p.percent) * shared >= p.percent * (F.col("n") + partner))
    return written(alive.select("bucket", "doc", "n", "comp"), "neardup-alive")


def near_duplicates(docs: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    rows, comps = find_components(docs, p)
    out = rows.join(comps.select(F.col("v").alias("rep"), "c"), "rep", "left")
    comp = F.coalesce("c", "rep", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        comp.alias("component_id"),
        F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, p: NearDupParams = PARAMS) -> DataFrame:
    """One text of each group: the row, with all columns, of its smallest id.

    Different texts under one id are decided each by itself; of rows that agree in
    id and text one stays, and all rows without an id.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    # the operator over texts: an id of its own for every text of a document, so ids tie nothing
    texts = docs.select(key.alias("doc_id"), "text")
    groups = near_duplicates(texts, p).filter("doc_id is not null").select(F.col("doc_id").alias("key"), "component_id")
    ids = docs.select("doc_id", key.alias("key")).filter("doc_id is not null").distinct()
    first = F.min(F.struct("doc_id", "key"))
    stay = groups.distinct().join(ids, "key").groupBy("component_id").agg(first.alias("x")).select("x.key")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    one = row.join(stay, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return one.select("row").union(row.filter("key is null").select("row")).select("row.*")
