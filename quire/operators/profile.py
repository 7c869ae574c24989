"""Dataset profiles and summaries (D1-D3, D7-D9, D11) as single aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, user_col: str = "user_id", item_col: str = "book_id",
            approximate: bool = False) -> DataFrame:
    """#ratings, #users, #books in one pass (D3); ``approximate`` uses HLL++."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.count("*").alias("n_ratings"),
        distinct(user_col).alias("n_users"),
        distinct(item_col).alias("n_books"),
    )


def describe(df: DataFrame, cols) -> DataFrame:
    """count / mean / stddev (sample) / min / max per column, one wide row."""
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}_count"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_stddev"),
            F.min(F.col(c).cast("double")).alias(f"{c}_min"),
            F.max(F.col(c).cast("double")).alias(f"{c}_max"),
        ]
    return df.agg(*aggs)


def crosstab(df: DataFrame, row_col: str, col_col: str, values, prefix: str = "r") -> DataFrame:
    """Contingency table with explicit values (D8): no extra distinct pass.

    Values that are not listed are counted in ``{prefix}_other``, nulls in
    ``{prefix}_null``, so every row of the table is counted once.
    """
    c = F.col(col_col)
    listed = c.isin([*values])
    counts = [F.count_if(c == v).alias(f"{prefix}{i}") for i, v in enumerate(values)]
    counts.append(F.count_if(c.isNotNull() & ~listed).alias(f"{prefix}_other"))
    counts.append(F.count_if(c.isNull()).alias(f"{prefix}_null"))
    return df.groupBy(row_col).agg(*counts)


def user_counts(df: DataFrame, n: int = 5, user_col: str = "user_id") -> DataFrame:
    """Interactions per user, first ``n`` users by id."""
    return df.groupBy(user_col).agg(F.count("*").alias("count")).orderBy(user_col).limit(n)
