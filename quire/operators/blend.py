"""Read/unread routing and prediction blending.

Prediction sets are projected to ``keys + score`` before the full outer joins
(the original left duplicate payload columns in), and the blend itself is a
``coalesce`` in priority order: review score, else ALS score, else the unread
model's score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.columns import clamp_zero, first_present

KEYS = ("user_id", "book_id", "rating")


def read_rows(df: DataFrame, flag_col: str = "is_read") -> DataFrame:
    """Rows of read interactions (B4); a pushed-down filter on a typed column."""
    return df.where(F.col(flag_col) != 0)


def unread_rows(df: DataFrame, flag_col: str = "is_read") -> DataFrame:
    """Rows of unread interactions (complement predicate of ``read_rows``)."""
    return df.where(F.col(flag_col) == 0)


def nan_drop_read(df: DataFrame, flag_col: str = "is_read", rating_col: str = "rating") -> DataFrame:
    """Blank unread ratings with NaN and drop incomplete rows.

    ``na.drop`` removes rows with a null *or NaN* in any column, so this also
    drops read rows with a missing field.
    """
    blanked = df.withColumn(
        rating_col,
        F.when(F.col(flag_col) == 0, F.lit(float("nan"))).otherwise(F.col(rating_col)),
    )
    return blanked.na.drop()


def unread_except(df: DataFrame, flag_col: str = "is_read") -> DataFrame:
    """all EXCEPT DISTINCT read (G4): also keeps read rows with a null column."""
    return df.subtract(nan_drop_read(df, flag_col))


def rename_prediction(df: DataFrame, new_name: str, old_name: str = "prediction") -> DataFrame:
    """B3; a no-op when the column is absent."""
    return df.withColumnRenamed(old_name, new_name)


def clamp_predictions(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Negative predictions become 0, no upper clamp."""
    return df.withColumn(col, clamp_zero(col))


def _project(df: DataFrame, score_col: str, new_name: str, keys=KEYS) -> DataFrame:
    return df.select(*keys, F.col(score_col).alias(new_name))


def outer_two(
    als: DataFrame,
    review: DataFrame,
    als_col: str = "prediction",
    review_col: str = "prediction",
    keys=KEYS,
) -> DataFrame:
    """Full outer join of ALS and review predictions on the keys."""
    return _project(als, als_col, "als_prediction", keys).join(
        _project(review, review_col, "review_prediction", keys), list(keys), "full_outer"
    )


def outer_three(
    als: DataFrame,
    review: DataFrame,
    unread: DataFrame,
    als_col: str = "prediction",
    review_col: str = "prediction",
    unread_col: str = "prediction",
    keys=KEYS,
) -> DataFrame:
    """Chained full outer joins of ALS-read, review and unread predictions."""
    return outer_two(als, review, als_col, review_col, keys).join(
        _project(unread, unread_col, "unread_prediction", keys), list(keys), "full_outer"
    )


def blend_two(als: DataFrame, review: DataFrame, **kw) -> DataFrame:
    """Review score where present, else ALS score (B7 after C5)."""
    joined = outer_two(als, review, **kw)
    return joined.withColumn(
        "total_prediction", first_present("review_prediction", "als_prediction")
    )


def blend_three(als: DataFrame, review: DataFrame, unread: DataFrame, **kw) -> DataFrame:
    """Review, else ALS-read, else unread score (B8 after C6)."""
    joined = outer_three(als, review, unread, **kw)
    return joined.withColumn(
        "total_prediction",
        first_present("review_prediction", "als_prediction", "unread_prediction"),
    )


def union_predictions(read_pred: DataFrame, unread_pred: DataFrame, cols=None) -> DataFrame:
    """Read and unread predictions as one table (G2), aligned by name."""
    cols = cols or [c for c in read_pred.columns if c in unread_pred.columns]
    return read_pred.select(*cols).unionByName(unread_pred.select(*cols))
