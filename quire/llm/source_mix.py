"""Mixing sources to target weights by blocks, multinomial shards and index permutations.

Each source's documents, in a pseudorandom order, form one stream of words,
packed into blocks of ``block_words``.  A source's target gives its number of
slots.  The mix is a sequence of output shards of ``shard_slots`` positions.  Every
position draws its source with probability in proportion to the slots, so a
shard's counts are multinomial.  A source's slots are numbered through the
shards; a position whose source is drawn more often than it has slots goes to
a source that was drawn too rarely (the k-th such position to the k-th missing
slot), so each source fills exactly its number.  The j-th slot of a source is
mapped through a pseudorandom permutation of the source's block indexes, a new
one for each pass over the source (a Feistel network keyed by seed, source and
pass, for any number of blocks), and joined with the block of that index.  A source fills at most two
passes, so no word is taken more than twice.

``mixed_blocks`` is the mix in its order: shard, position, source and block.

Defined results: null text has size 0; a null source is a source of its own,
last in order; documents with a null doc_id are ordered by their texts' hashes;
repeated rows are documents of their own; documents of size 0 are taken 0
words; texts of any length are cut at blocks; without any words all targets are
0; an empty table gives an empty result; other columns, whatever their names,
are only carried along.  Reruns agree: every draw depends on the seed and the
data alone, not on partitions.  Another seed gives another mix of the same
totals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm import textkit as tk
from quire.llm.common import WORD, partitions_for, written


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)
    #: the mix as a share of all sizes, in percent
    percent: int = 150
    max_repeats: int = 2
    block_words: int = 32
    shard_slots: int = 4096
    seed: int = 7


PARAMS = MixParams()


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, size of every row (written: the only pass over the texts)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        "source",
        F.xxhash64(text).alias("text_key"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long").alias("size"),
    )
    return written(sized, "mix-sizes")


def source_targets(sizes: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """idx, source, source_size, target, blocks, slots: one row per source.

    Targets in closed form: sources ordered by cap / weight are capped as long
    as the level reached without them is not below their own.
    """
    k = len(p.weights)
    order = W.orderBy(F.col("source").asc_nulls_last())
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = total.withColumn("idx", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in p.weights]), (F.col("idx") % k + 1).cast("int")).cast("long")
    ranked = ranked.withColumn("w", weight).withColumn("cap", p.max_repeats * F.col("source_size"))
    by_level = W.orderBy(F.col("cap") / F.col("w"), "idx").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    budget = F.lit(p.percent / 100.0) * F.sum("source_size").over(every)
    before = lambda c: F.coalesce(F.sum(c).over(by_level), F.lit(0))
    levels = ranked.select(
        "*",
        budget.alias("budget"),
        ((budget - before("cap")) / (F.sum("w").over(every) - before("w"))).alias("level"),
    ).withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    free_w = F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(every)
    used = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    share = F.col("w") * (F.col("budget") - used) / F.when(free_w > 0, free_w)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
    blocks = F.ceil(F.col("source_size") / p.block_words).cast("long")
    out = levels.select("idx", "source", "source_size", target.alias("target"), blocks.alias("blocks"))
    slots = F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5).cast("long")
    out = out.withColumn("slots", F.when(F.col("source_size") > 0, slots).otherwise(F.lit(0).cast("long")))
    return written(out.coalesce(1), "mix-targets")


def document_offsets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every row with idx and its offset in its source's word stream.

    The stream is ordered by a hash of doc_id.  Offsets come from sums per hash
    prefix and running sums inside a prefix, so no task sorts a whole source.
    """
    t = targets.select("idx", "source", "source_size", "target").alias("t")
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.col("text_key").cast("string")))
    key = F.md5(named.cast("binary"))
    rows = (
        sizes.alias("s")
        .join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.*", "idx", "source_size", "target", key.alias("order_key"))
        .withColumn("prefix", F.substring("order_key", 1, 4))
    )
    sums = rows.groupBy("idx", "prefix").agg(F.sum("size").alias("words"))
    before = W.partitionBy("idx").orderBy("prefix").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("idx", "prefix", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = (
        W.partitionBy("idx", "prefix")
        .orderBy("order_key", "doc_id", "size", "text_key")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["idx", "prefix"])
        .withColumn("offset", F.col("start") + F.col("inner"))
        .drop("prefix", "order_key", "inner", "start")
    )


#: shards whose numbers are worked out together
_SHARDS = 1024
#: rows that one task lists
_ROWS = 1 << 19
#: modulus of the permutation's rounds, a prime below 2**31 (fixed value)
_PRIME = 2147483647
#: cycle walking: up to 1,600 blocks fewer than 40 cells are beyond the blocks, so these
#: steps always suffice; above, a number needs them all with a probability below 40**-40
_WALK = 40


def _hash(*parts) -> Column:
    """60 bits of a hash of the parts, the same in SQL."""
    text = F.concat_ws(":", *[(F.lit(x) if isinstance(x, (str, int)) else x).cast("string") for x in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def shard_counts(targets: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """shard, idx, n, start: the multinomial counts of every shard, and the number of the first slot.

    A position's source is found by a table of cells: a cell lists the sources
    whose range of slots reaches into it, one or two of them.  Slots are numbered
    by sums over groups of shards and inside a group, so no task sees all shards
    of a source.
    """
    spark = targets.sparkSession
    total, sources = targets.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], "shard long, idx int, n long, start long")
    cells = max(4096, 4 * sources)
    upto = F.sum("slots").over(W.orderBy("idx"))
    ranges = targets.filter("slots > 0").select("idx", (upto - F.col("slots")).alias("lo"), upto.alias("hi"))
    cell = lambda at: F.floor(at * F.lit(cells) / F.lit(total)).cast("long")
    # one cell more on either side than rounding could miss
    reach = F.sequence(cell(F.col("lo")) - 1, cell(F.col("hi")) + 1)
    guide = ranges.select("idx", "lo", "hi", F.explode(reach).alias("cell"))
    drawn = spark.range(total).select(
        F.floor(F.col("id") / p.shard_slots).cast("long").alias("shard"),
        F.pmod(_hash("draw", p.seed, F.col("id")), F.lit(total)).alias("at"),
    )
    chosen = drawn.withColumn("cell", cell(F.col("at"))).join(guide, "cell").filter("at >= lo and at < hi")
    counts = written(chosen.groupBy("shard", "idx").agg(F.count("*").alias("n")), "mix-counts")
    grouped = counts.withColumn("group", F.floor(F.col("shard") / _SHARDS))
    sums = grouped.groupBy("idx", "group").agg(F.sum("n").alias("words"))
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    base = sums.select("idx", "group", F.coalesce(F.sum("words").over(before("idx", "group")), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("n").over(before("idx", "group", "shard")), F.lit(0))
    placed = grouped.withColumn("inner", inner).join(base, ["idx", "group"])
    return placed.select("shard", "idx", "n", (F.col("base") + F.col("inner")).alias("start"))


def slots(targets: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """shard, idx, slot: every position of the mix; each source has its slots 0..n-1 once."""
    counts = shard_counts(targets, p)
    had = counts.groupBy("idx").agg(F.sum("n").alias("had"))
    off = targets.select("idx", "slots").join(had, "idx", "left").select(
        "idx", "slots", F.coalesce("had", F.lit(0)).alias("had")
    )
    extra, short = F.greatest(F.col("had") - F.col("slots"), F.lit(0)), F.greatest(F.col("slots") - F.col("had"), F.lit(0))
    first = lambda c: F.sum(c).over(W.orderBy("idx")) - c
    off = off.select("idx", "slots", "had", first(extra).alias("extra_at"), short.alias("short"), first(short).alias("short_at"))
    missing = off.filter("short > 0").select(
        F.col("idx").alias("to"), "had", F.posexplode(F.sequence(F.col("short_at"), F.col("short_at") + F.col("short") - 1)).alias("j", "k")
    )
    # shards are dealt out, over a number that is not coalesced, before their positions are listed
    total = targets.agg(F.sum("slots")).first()[0] or 0
    dealt = counts.join(off.select("idx", "slots", "extra_at"), "idx").repartition(
        partitions_for(targets.sparkSession, total, _ROWS), "shard"
    )
    each = dealt.select(
        "shard", "idx", "slots", "extra_at", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("slot")
    )
    own = each.filter("slot < slots").select("shard", "idx", "slot")
    over = each.filter("slot >= slots").withColumn("k", F.col("extra_at") + F.col("slot") - F.col("slots"))
    moved = over.join(missing, "k").select("shard", F.col("to").alias("idx"), (F.col("had") + F.col("j")).alias("slot"))
    return own.unionByName(moved)


def _round_keys(idx: Column, turn: int, p: MixParams) -> list[Column]:
    """Three pairs of rounds for a source and pass: multipliers and shifts from the seed."""
    out = []
    for k in range(3):
        a1, b1, a2, b2 = (_hash("order", p.seed, idx, turn, 4 * k + j) for j in range(4))
        odd = [(x % (_PRIME - 1) + 1).alias(n) for x, n in ((a1, "a1"), (a2, "a2"))]
        out.append(F.struct(*odd, (b1 % _PRIME).alias("b1"), (b2 % _PRIME).alias("b2")))
    return out


def permute(rows: DataFrame) -> DataFrame:
    """Rows with ``block``: place i of 0..blocks-1 under a keyed permutation of these numbers.

    ``rows`` have i, blocks, wide, high and keys.  A Feistel network on
    wide x high >= blocks cells: a half is shifted by a mixed value of the other,
    in turn.  A result beyond the blocks goes in again (cycle walking); fewer
    than sqrt(blocks) cells are beyond, so few do.
    """
    blocks, wide, high = F.col("blocks"), F.col("wide"), F.col("high")

    def mixed(v: Column, a: Column, b: Column, m: Column) -> Column:
        t = (v * a + b) % _PRIME
        return (t * t) % _PRIME % m

    def once(x: Column) -> Column:
        def pair(s: Column, k: Column) -> Column:
            left = (s["l"] + mixed(s["r"], k["a1"], k["b1"], wide)) % wide
            return F.struct(left.alias("l"), ((s["r"] + mixed(left, k["a2"], k["b2"], high)) % high).alias("r"))

        start = F.struct(F.floor(x / high).alias("l"), (x % high).alias("r"))
        return F.aggregate("keys", start, pair, lambda s: s["l"] * high + s["r"])

    first = rows.withColumn("first", once(F.col("i")))
    again = F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALK)), F.col("first"), lambda x, _: F.when(x < blocks, x).otherwise(once(x))
    )
    return first.withColumn("block", F.when(F.col("first") < blocks, F.col("first")).otherwise(again))


def slot_blocks(targets: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """shard, idx, slot, block: every position of the mix with the block that fills it."""
    wide = F.ceil(F.sqrt(F.col("blocks"))).cast("bigint")
    sides = targets.filter("slots > 0").withColumn("wide", wide)
    high = F.floor((F.col("blocks") + F.col("wide") - 1) / F.col("wide")).cast("bigint")
    keys = F.array(*[F.array(*_round_keys(F.col("idx"), t, p)) for t in range(p.max_repeats)])
    sides = sides.select("idx", "blocks", "wide", high.alias("high"), keys.alias("keys"))
    turn = F.floor(F.col("slot") / F.col("blocks")).cast("int")
    numbered = slots(targets, p).join(sides, "idx").select(
        "shard", "idx", "slot", "blocks", "wide", "high", (F.col("slot") % F.col("blocks")).alias("i"),
        F.get("keys", turn).alias("keys"),
    )
    return permute(numbered).select("shard", "idx", "slot", "block")


def mixed_blocks(targets: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """shard, position, source, idx, block: the mix in its order; positions from 0 in each shard."""
    placed = slot_blocks(targets, p).withColumn("key", _hash("place", p.seed, F.col("idx"), F.col("slot")))
    position = F.row_number().over(W.partitionBy("shard").orderBy("key", "idx", "slot")) - 1
    return placed.withColumn("position", position).join(targets.select("idx", "source"), "idx").select(
        "shard", "position", "source", "idx", "block"
    )


def pieces(offsets: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """A row per document and block it reaches into: idx, block, offset, first word in the document, words."""
    first = F.floor(F.col("offset") / p.block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / p.block_words)
    each = offsets.filter("size > 0").select("idx", "offset", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("offset"), F.col("block") * p.block_words)
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * p.block_words)
    return each.select("idx", "block", "offset", (begin - F.col("offset")).alias("word"), (end - begin).alias("words"))


def _taken(docs: DataFrame, p: MixParams) -> tuple[DataFrame, DataFrame]:
    """(rows with offsets, their pieces with ``times``)."""
    sizes = document_sizes(docs)
    targets = source_targets(sizes, p)
    offsets = written(document_offsets(sizes, targets), "mix-offsets")
    times = slot_blocks(targets, p).groupBy("idx", "block").agg(F.count("*").alias("times"))
    return offsets, pieces(offsets, p).join(times.hint("merge"), ["idx", "block"])


def mix(docs: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    offsets, got = _taken(docs, p)
    # a document of one or more words has its own offset in its source
    taken = got.groupBy("idx", "offset").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    sized = offsets.withColumn("has", F.col("size") > 0)
    joined = sized.join(taken.withColumn("has", F.lit(True)).hint("merge"), ["idx", "offset", "has"], "left")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def _cut_words(max_repeats: int):
    word = re.compile(WORD)

    def cut(text: str, parts: list[dict]) -> str:
        spans = [m.span() for m in word.finditer(text)]
        out = []
        for turn in range(1, max_repeats + 1):
            runs: list[list[int]] = []
            for x in sorted((x for x in parts if x["times"] >= turn), key=lambda x: x["word"]):
                if runs and runs[-1][1] == x["word"]:
                    runs[-1][1] += x["words"]
                else:
                    runs.append([x["word"], x["word"] + x["words"]])
            out += [text[spans[a][0] : spans[b - 1][1]] for a, b in runs]
        return "\n".join(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            parts = batch.column("parts")
            new = [cut(texts[i].as_py(), parts[i].as_py()) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], names=["row", "text"])

    return run


def mixed_documents(docs: DataFrame, p: MixParams = PARAMS) -> DataFrame:
    """The documents that the mix takes words of, all columns; ``text`` has the words taken, repeats again.

    ``n_chars``, where there is one, follows.  Documents without a taken word go.
    """
    offsets, got = _taken(docs, p)
    parts = got.groupBy("idx", "offset").agg(F.collect_list(F.struct("word", "words", "times")).alias("parts"))
    plan = offsets.filter("size > 0").join(parts.hint("merge"), ["idx", "offset"])
    # rows that agree in doc_id, source and text are told apart by a number
    same = W.partitionBy("doc_id", "source", "text_key")
    plan = plan.withColumn("copy", F.row_number().over(same.orderBy("offset")))
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        "doc_id",
        "source",
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    ).withColumn("copy", F.row_number().over(same.orderBy("text_key")))
    keys = ("doc_id", "source", "text_key", "copy")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    both = rows.alias("r").join(plan.alias("p"), on).select("row", "text", "parts")
    row_type = both.schema["row"].dataType.simpleString()
    out = both.mapInArrow(tk.frugal(_cut_words(p.max_repeats)), f"row {row_type}, text string")
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            cols.append(F.when(F.col("row.n_chars").isNotNull(), F.char_length("text")).cast(kind).alias("n_chars"))
        else:
            cols.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*cols)
