"""User-level sampling and the leakage-aware train / validation / test split.

Everything is a deterministic hash bucket of the ids (``hash_bucket``), so a
row's fate is decided by a projection: no shuffle, no driver-side fraction
maps, and the same rows at any partition count or cluster size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket
from quire.operators.ranking import row_number_by_hash
from quire.session import written

SAMPLE_BUCKETS = 10_000


@dataclass(frozen=True)
class SplitSpec:
    """Bucket layout of the split.

    ``user_buckets`` buckets per user; the first ``train_buckets`` go to train,
    the next ``val_buckets`` to validation, the rest to test.  Each held-out
    user's rows fall in ``row_buckets`` row buckets; the first
    ``observed_buckets`` are observed (moved into train), the rest held out.
    """

    seed: int = 2020
    user_buckets: int = 10
    train_buckets: int = 6
    val_buckets: int = 2
    row_buckets: int = 2
    observed_buckets: int = 1
    user_col: str = "user_id"
    item_col: str = "book_id"


DEFAULT_SPLIT = SplitSpec()


def sample_users(
    df: DataFrame, fraction: float, seed: int = 2020, user_col: str = "user_id"
) -> DataFrame:
    """Keep every interaction of a hashed ``fraction`` of users (H1 + C1).

    A single filter over the scan: no distinct, no join, no shuffle.
    """
    cut = int(round(fraction * SAMPLE_BUCKETS))
    bucket = hash_bucket(f"{seed}s", user_col) % SAMPLE_BUCKETS
    return df.where(bucket < cut)


def part_column(spec: SplitSpec = DEFAULT_SPLIT):
    """'train' | 'val' | 'test' from the user's bucket."""
    ub = hash_bucket(spec.seed, spec.user_col) % spec.user_buckets
    return (
        F.when(ub < spec.train_buckets, F.lit("train"))
        .when(ub < spec.train_buckets + spec.val_buckets, F.lit("val"))
        .otherwise(F.lit("test"))
    )


def half_column(spec: SplitSpec = DEFAULT_SPLIT):
    """0 (observed) | 1 (held out) from the (user, item) row bucket."""
    rb = hash_bucket(spec.seed, spec.user_col, spec.item_col) % spec.row_buckets
    return F.when(rb < spec.observed_buckets, F.lit(0)).otherwise(F.lit(1))


def with_split_columns(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """Add ``part`` ('train' | 'val' | 'test') and ``half`` (0 observed, 1 held out)."""
    return df.withColumn("part", part_column(spec)).withColumn("half", half_column(spec))


def split_users(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """(user, part) per distinct user (H2)."""
    return df.select(spec.user_col).distinct().withColumn("part", part_column(spec))


def half_rows(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """Rows with their hash half (H3): 0 observed, 1 held out."""
    return df.withColumn("half", half_column(spec))


def exact_half(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """Exactly ceil(n/2) observed rows per user (H3 variant), so every user keeps history.

    Rows are ordered by (row hash, item).  The per-user row number is computed
    skew-safely (``row_number_by_hash``): a user holding a third of all rows is
    spread over many tasks instead of one.
    """
    h = hash_bucket(spec.seed, spec.user_col, spec.item_col)
    ranked = row_number_by_hash(
        df.withColumn("_h", h), spec.user_col, "_h", spec.item_col, out="_rn", count_out="_n"
    )
    return ranked.withColumn(
        "half", F.when(F.col("_rn") <= F.ceil(F.col("_n") / 2.0), F.lit(0)).otherwise(F.lit(1))
    ).drop("_h", "_rn", "_n")


def with_history(heldout: DataFrame, observed: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Keep held-out rows of users that have at least one observed row.

    The build side is de-duplicated first (a partial aggregate shrinks it to at
    most one row per user), so AQE can broadcast it and the held-out rows are
    never shuffled; otherwise it is a skew-split sort-merge semi join.
    """
    return heldout.join(observed.select(user_col).distinct(), user_col, "left_semi")


def split_recipe(
    df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The full recipe (H4): ``train, val, test``.

    * train = every row of train users + the observed half of val/test users;
    * val / test = the held-out half of val / test users that have history.
    """
    cols = df.columns
    rows = with_split_columns(df, spec)
    train = rows.where((F.col("part") == "train") | (F.col("half") == 0)).select(*cols)
    observed = rows.where((F.col("part") != "train") & (F.col("half") == 0))
    val = with_history(
        rows.where((F.col("part") == "val") & (F.col("half") == 1)), observed, spec.user_col
    ).select(*cols)
    test = with_history(
        rows.where((F.col("part") == "test") & (F.col("half") == 1)), observed, spec.user_col
    ).select(*cols)
    return train, val, test


def split_table(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """The three parts as one table with a ``part`` column (for partitioned writes).

    Two branches over the input: rows that go to train (train users and every
    observed half) and held-out rows of users with history, labelled by part.
    Users and rows are hashed once: the branches read what was written.
    """
    cols = df.columns
    rows = written(with_split_columns(df, spec), "split-rows")
    to_train = (F.col("part") == "train") | (F.col("half") == 0)
    train = rows.where(to_train).select(*cols, F.lit("train").alias("part"))
    observed = rows.where((F.col("part") != "train") & (F.col("half") == 0))
    held = with_history(rows.where(~to_train), observed, spec.user_col)
    return train.unionByName(held.select(*cols, "part"))


def split_report(df: DataFrame, spec: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """Counts per (part, half): rows and distinct users (H6) in one aggregate."""
    return (
        with_split_columns(df, spec)
        .groupBy("part", "half")
        .agg(
            F.count("*").alias("n_rows"),
            F.countDistinct(spec.user_col).alias("n_users"),
        )
    )


def min_activity(df: DataFrame, min_count: int = 10, user_col: str = "user_id") -> DataFrame:
    """Drop users with fewer than ``min_count`` interactions (H7)."""
    active = df.groupBy(user_col).count().where(F.col("count") >= min_count)
    return df.join(active.select(user_col), user_col, "left_semi")


def seen_items_only(df: DataFrame, train: DataFrame, item_col: str = "book_id") -> DataFrame:
    """Drop rows whose item never occurs in training (H8); de-duplicated build side."""
    return df.join(train.select(item_col).distinct(), item_col, "left_semi")


def union_observed(train_users_rows: DataFrame, *observed: DataFrame) -> DataFrame:
    """UNION ALL of train with observed halves, by column name (G1)."""
    out = train_users_rows
    for o in observed:
        out = out.unionByName(o)
    return out


def held_out_except(part_rows: DataFrame, observed: DataFrame, keep_all: bool = False) -> DataFrame:
    """held-out = all - observed (G3): EXCEPT DISTINCT, or EXCEPT ALL with ``keep_all``.

    Prefer the complement predicate (``half == 1``) which needs no shuffle;
    this form is for callers holding two arbitrary tables.
    """
    return part_rows.exceptAll(observed) if keep_all else part_rows.subtract(observed)
