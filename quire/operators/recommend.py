"""Top-k over the whole catalogue with seen items left out inside the search.

Items are put in order of their factors' norm and cut into waves; a wave is one
packed row (ids and factors of at most ``wave_items`` items).  Users are packed
into blocks, each with a bounded heap of k items per user.  Blocks are dealt out to
lanes, tasks of bounded memory that keep the heaps while all waves pass by, in
order.  Before a wave come the lane's seen pairs of that wave alone: a seen pair is
left out before anything enters a heap, so one user's long history neither lengthens
another's list nor is ever held whole.  No heap is written before it is finished.

Inside a wave items come in tiles, largest norm first.  The inner product is at
most the product of the norms, so a user whose heap's last score is above that
bound skips the tile and all later ones; so does a block whose users are all done.
What is skipped cannot enter a heap: the result is exact.

Positions go by score, equal scores by the smaller item id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.factors import dot
from quire.session import written


@dataclass(frozen=True)
class RecommendParams:
    #: users of a block, items of a wave (one packed row) and of a tile inside it
    block_users: int = 1024
    wave_items: int = 65_536
    tile_items: int = 2048
    #: users that meet a tile at a time
    rows: int = 256
    #: users of a lane: a task that holds their heaps while the waves pass by
    lane_users: int = 65_536


DEFAULT = RecommendParams()
#: rows that a lane takes at a time; a wave is one row of some megabytes
FEED_ROWS = 8
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
STATE = "block int, users binary, items binary, scores binary, compared long"


# -- packing -----------------------------------------------------------------------


def ordered_items(items: DataFrame, item_col: str) -> DataFrame:
    """(item, factors, norm, pos): positions from 0 by falling norm, without a global window.

    Range partitions are numbered inside; the driver adds up their sizes.
    """
    norm = F.sqrt(dot(F.col("factors"), F.col("factors")))
    usable = F.col("factors").isNotNull() & ~F.isnan("norm")
    flat = items.select(F.col(item_col).cast("long").alias("item"), "factors", norm.alias("norm")).where(usable)
    placed = flat.repartitionByRange(F.col("norm").desc(), F.col("item")).sortWithinPartitions(
        F.col("norm").desc(), "item"
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            idx = pa.array(np.arange(at, at + b.num_rows, dtype=np.int64))
            at += b.num_rows
            yield pa.record_batch(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), idx], names=[*b.schema.names, "part", "idx"]
            )

    numbered = written(
        placed.mapInArrow(number, "item long, factors array<float>, norm double, part int, idx long"), "items-by-norm"
    )
    sizes = sorted(numbered.groupBy("part").count().collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = numbered.sparkSession.createDataFrame(starts, "part int, start long")
    return numbered.join(F.broadcast(offsets), "part").select("item", "factors", "norm", (F.col("start") + F.col("idx")).alias("pos"))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().astype(np.float32).reshape(rows, -1)


def _pack_wave(group: pa.Table) -> pa.Table:
    """One wave as a row; items keep their order of position."""
    order = np.argsort(group["pos"].to_numpy())
    ids, matrix = group["item"].to_numpy()[order].astype(np.int64), _matrix(group["factors"], group.num_rows)[order]
    return _packed("wave", group["wave"][0].as_py(), ids, matrix)


def _pack_users(group: pa.Table) -> pa.Table:
    order = np.argsort(group["user"].to_numpy())
    users = group["user"].to_numpy()[order].astype(np.int64)
    return _packed("block", group["block"][0].as_py(), users, _matrix(group["factors"], len(users))[order])


def _pack_pairs(group: pa.Table) -> pa.Table:
    """A block's seen pairs of one wave: users and places in the wave."""
    users, places = group["user"].to_numpy().astype(np.int64), group["place"].to_numpy().astype(np.int32)
    one = _packed("block", group["block"][0].as_py(), users, places)
    return one.append_column("wave", pa.array([group["wave"][0].as_py()], pa.int32()))


def _packed(name: str, no: int, ids: np.ndarray, rest: np.ndarray) -> pa.Table:
    return pa.table({
        name: pa.array([no], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
        "matrix": pa.array([np.ascontiguousarray(rest).tobytes()], pa.binary()),
    })


# -- a wave meets a block ------------------------------------------------------------


def _merge(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row: by score, then the smaller id; unordered except for ties at the end."""
    n = scores.shape[1]
    if n <= k:
        return scores, ids
    last = np.partition(scores, n - k, axis=1)[:, n - k]
    above = scores > last[:, None]
    tied = scores == last[:, None]
    need = k - above.sum(axis=1)
    for r in np.flatnonzero(tied.sum(axis=1) > need):
        cols = np.flatnonzero(tied[r])
        drop = cols[np.argsort(ids[r, cols], kind="stable")[need[r] :]]
        tied[r, drop] = False
    keep = above | tied
    return scores[keep].reshape(-1, k), ids[keep].reshape(-1, k)


class Block:
    """Users with their heaps: k places each, empty ones as -inf."""

    def __init__(self, users: np.ndarray, factors: np.ndarray, k: int):
        self.users, self.factors, self.exact, self.k = users, factors, factors.astype(float), k
        self.length = np.sqrt((self.exact**2).sum(axis=1))
        self.scores = np.full((len(users), k), -np.inf)
        self.ids = np.full((len(users), k), np.iinfo(np.int64).max)
        self.last = np.full(len(users), -np.inf)
        self.compared = 0

    def reach(self, who: np.ndarray | slice, norm: float) -> np.ndarray:
        """Whose heaps an item of this norm may enter; rounding of the products is far below the slack."""
        return self.length[who] * norm * (1 + 1e-9) >= self.last[who]

    def meet(self, wave, seen, p: RecommendParams) -> None:
        """``wave``: (ids, matrix, norms) by falling norm; ``seen``: (user row, place in the wave) pairs.

        Products of single precision, less their rounding error, pick the pairs that may
        enter a heap; these alone are computed in double precision and kept.
        """
        item_ids, matrix, norms = wave
        known = np.sort(seen[0] * len(item_ids) + seen[1])
        small = len(self.users) and self.length.max() * norms[0] < 1e30
        left, right = (self.factors, matrix) if small else (self.exact, matrix.astype(float))
        error = (matrix.shape[1] + 2) * 2.0**-23
        for a in range(0, len(self.users), p.rows):
            chunk = np.arange(a, min(a + p.rows, len(self.users)))
            found, waiting = [], 0
            for lo in range(0, len(item_ids), p.tile_items):
                who = chunk[self.reach(chunk, norms[lo])]
                if not len(who):
                    break
                hi = min(lo + p.tile_items, len(item_ids))
                s = left[who] @ right[lo:hi].T
                self.compared += s.size
                cut = self.last[who] - error * self.length[who] * norms[lo] - 1e-30
                cut = np.nextafter(cut.astype(s.dtype), s.dtype.type(-np.inf))
                r, c = np.divmod(np.flatnonzero(s >= cut[:, None]), hi - lo)
                rows, places = who[r], c + lo
                key = rows * len(item_ids) + places
                at = np.searchsorted(known, key)
                new = np.append(known, -1)[at] != key
                rows, places = rows[new], places[new]
                x = np.einsum("ij,ij->i", self.exact[rows], matrix[places].astype(float))
                good = x >= self.last[rows]
                found.append((rows[good], item_ids[places[good]], x[good]))
                waiting += len(found[-1][0])
                if waiting >= len(chunk) * self.k:
                    self._take(found)
                    found, waiting = [], 0
            if waiting:
                self._take(found)

    def _take(self, found: list) -> None:
        """What was found goes into the heaps of its users."""
        rows, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        who, n = np.unique(rows, return_counts=True)
        order = np.argsort(rows, kind="stable")
        at = (np.repeat(np.arange(len(who)), n), np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n))
        more = np.full((len(who), n.max()), -np.inf)
        names = np.full(more.shape, np.iinfo(np.int64).max)
        more[at], names[at] = scores[order], ids[order]
        self.scores[who], self.ids[who] = _merge(
            np.concatenate((self.scores[who], more), axis=1), np.concatenate((self.ids[who], names), axis=1), self.k
        )
        self.last[who] = self.scores[who].min(axis=1)


def _lane(k: int, p: RecommendParams):
    """The rows of a lane in order: its blocks, then every wave behind its seen pairs of that wave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, Block] = {}
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for j in range(b.num_rows):
                kind, no, first, second = (b[c][j].as_py() for c in ("kind", "block", "ids", "matrix"))
                ids = np.frombuffer(first, np.int64)
                if kind == 0:
                    blocks[no] = Block(ids, np.frombuffer(second, np.float32).reshape(len(ids), -1), k)
                elif kind == 1:
                    if no in blocks:
                        seen[no] = np.searchsorted(blocks[no].users, ids), np.frombuffer(second, np.int32).astype(np.int64)
                else:
                    matrix = np.frombuffer(second, np.float32).reshape(len(ids), -1)
                    norms = np.maximum.accumulate(np.sqrt((matrix.astype(float) ** 2).sum(axis=1))[::-1])[::-1]
                    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    for n, block in blocks.items():
                        if block.reach(slice(None), norms[0]).any():
                            block.meet((ids, matrix, norms), seen.get(n, none), p)
                    seen = {}
        while blocks:
            n, x = blocks.popitem()
            rows = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            m = len(x.users)
            yield pa.record_batch(
                [pa.array(np.full(m, n, np.int32)), rows(x.users), rows(x.ids), rows(x.scores),
                 pa.array(np.concatenate(([x.compared], np.zeros(m, np.int64)))[:m], pa.int64())],
                names=["block", "users", "items", "scores", "compared"],
            )

    return run


#: users whose lists are put in order at a time
LIST_USERS = 512


def _lists(k: int):
    """Heaps as (user, item, pos, prediction) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, LIST_USERS):
                users, ids, scores = (
                    np.frombuffer(b"".join(b[c].slice(lo, LIST_USERS).to_pylist()), kind)
                    for c, kind in (("users", np.int64), ("items", np.int64), ("scores", float))
                )
                scores, ids = scores.reshape(len(users), -1), ids.reshape(len(users), -1)
                order = np.lexsort((ids, -scores), axis=1)
                scores, ids = np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)
                real = scores > -np.inf
                pos = np.broadcast_to(np.arange(1, scores.shape[1] + 1, dtype=np.int32), scores.shape)
                yield pa.record_batch(
                    [pa.array(np.repeat(users, real.sum(axis=1))), pa.array(ids[real]), pa.array(pos[real]), pa.array(scores[real])],
                    names=["user", "item", "pos", "prediction"],
                )

    return run


def user_blocks(users: DataFrame, user_col: str, p: RecommendParams = DEFAULT) -> tuple[DataFrame, int]:
    """(user, factors, block) of users with factors, and their number; blocks by a hash of the id."""
    flat = users.select(F.col(user_col).cast("long").alias("user"), "factors").where(F.col("factors").isNotNull())
    flat = written(flat, "asked-users")
    n = flat.count()
    blocks = max(1, -(-n // p.block_users))
    return flat.withColumn("block", F.pmod(F.xxhash64("user"), F.lit(blocks)).cast("int")), n


def lanes_for(n_users: int, cores: int, p: RecommendParams = DEFAULT) -> int:
    """Tasks that hold the heaps: at most ``lane_users`` users in each, a whole number of rounds of the cores."""
    most = -(-n_users // p.block_users)
    return max(1, min(most, cores * -(-n_users // (p.lane_users * cores))))


def search(
    users: DataFrame,
    items: DataFrame,
    k: int,
    user_col: str = "user_id",
    item_col: str = "book_id",
    seen: DataFrame | None = None,
    p: RecommendParams = DEFAULT,
) -> DataFrame:
    """Finished heaps (``STATE``), a row per user: the k best items that are not in ``seen``.

    ``users`` and ``items``: (id, factors).  ``compared`` counts the pairs of a
    block whose scores were computed, in its first row.  Heaps stay in the task of their
    lane and are written once, as small rows: a file's writer and readers hold many rows
    at a time.  Every wave is sent once to each lane, which takes ``FEED_ROWS`` rows at a time.
    """
    spark = users.sparkSession
    placed = ordered_items(items, item_col).withColumn("wave", (F.col("pos") / p.wave_items).cast("int"))
    waves = placed.groupBy("wave").applyInArrow(_pack_wave, "wave int, ids binary, matrix binary")
    asked, n = user_blocks(users, user_col, p)
    if not n or placed.isEmpty():
        return spark.createDataFrame([], STATE)
    lanes = lanes_for(n, spark.sparkContext.defaultParallelism, p)
    packed = asked.groupBy("block").applyInArrow(_pack_users, "block int, ids binary, matrix binary")
    own = F.pmod("block", F.lit(lanes)).cast("int").alias("lane")
    feed = packed.select(own, F.lit(-1).alias("wave"), F.lit(0).alias("kind"), "block", "ids", "matrix").unionByName(
        waves.select(
            F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), "wave", F.lit(2).alias("kind"),
            F.lit(-1).alias("block"), "ids", "matrix",
        )
    )
    if seen is not None:
        known = seen.select(F.col(user_col).cast("long").alias("user"), F.col(item_col).cast("long").alias("item"))
        place = F.pmod("pos", F.lit(p.wave_items)).cast("int").alias("place")
        pairs = (
            known.join(asked.select("user", "block"), "user").distinct().join(placed.select("item", "pos", "wave"), "item")
            .select("block", "wave", "user", place)
            .groupBy("block", "wave").applyInArrow(_pack_pairs, "block int, ids binary, matrix binary, wave int")
        )
        feed = feed.unionByName(pairs.select(own, "wave", F.lit(1).alias("kind"), "block", "ids", "matrix"))
    streams = feed.repartitionById(lanes, F.col("lane")).sortWithinPartitions("wave", "kind")
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(FEED_ROWS))
    try:
        return written(streams.mapInArrow(_lane(k, p), STATE), "user-heaps")
    finally:
        spark.conf.set(ARROW_ROWS, before)


def top_items(
    users: DataFrame,
    items: DataFrame,
    k: int,
    user_col: str = "user_id",
    item_col: str = "book_id",
    seen: DataFrame | None = None,
    p: RecommendParams = DEFAULT,
) -> DataFrame:
    """(user, item, pos, prediction): each user's k best items that are not in ``seen``."""
    blocks = search(users, items, k, user_col, item_col, seen, p)
    flat = blocks.mapInArrow(_lists(k), "user long, item long, pos int, prediction double")
    kinds = {f.name: f.dataType for f in [*users.schema.fields, *items.schema.fields]}
    return flat.select(
        F.col("user").cast(kinds[user_col]).alias(user_col), F.col("item").cast(kinds[item_col]).alias(item_col),
        "pos", "prediction",
    )
