"""Cold-start items: observable features mapped to the learned item factors.

A linear map with one target per factor dimension is fitted on the items that
the model has seen.  All targets share one design matrix, so one pass over the
items is enough: the Gram matrix of (features, factors) holds the sums of outer
products of the features with themselves and with every target.  Spark sums it
by a tree on the executors; the driver solves a system of the features' size.

The evaluation holds items out of training and compares, on the same held-out
pairs, the mapped factors with the full model's (which has seen the items) and
with the mean item.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators import models as MD
from quire.operators.factors import dot, item_factors, score_factors, user_factors


def item_features(
    items: DataFrame,
    id_col: str = "book_id",
    categories: tuple[str, ...] = (),
    words: tuple[str, ...] = (),
    numbers: tuple[str, ...] = (),
    buckets: int = 64,
) -> DataFrame:
    """(id, x): 1, standardised numbers, and counts of category values and words in hash buckets.

    A null number counts as its mean, a null category or text as absent.  The
    means and deviations are one aggregate row.
    """
    stats = items.agg(
        F.lit(1).alias("_one"),
        *[F.avg(c).alias(f"m_{c}") for c in numbers],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in numbers],
    ).first()
    scaled = []
    for c in numbers:
        mean, dev = stats[f"m_{c}"] or 0.0, stats[f"s_{c}"] or 1.0
        scaled.append(F.coalesce((F.col(c).cast("double") - mean) / dev, F.lit(0.0)))
    values = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in categories]
    tokens = [F.array(*values)] if values else []
    tokens += [
        F.transform(F.split(F.lower(F.col(c)), r"\s+"), lambda w, c=c: F.concat(F.lit(f"{c}:"), w)) for c in words
    ]
    none = F.array().cast("array<string>")
    all_tokens = F.concat(none, *[F.coalesce(t, none) for t in tokens])
    cells = F.transform(
        F.filter(all_tokens, lambda t: t.isNotNull()), lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")
    )
    hashed = items.select(F.col(id_col), F.array(F.lit(1.0), *scaled).alias("_n"), cells.alias("_c"))
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(buckets - 1)),
        lambda i: F.size(F.filter(F.col("_c"), lambda c: c == i)).cast("double"),
    )
    return hashed.select(id_col, F.concat("_n", counts).alias("x"))


@dataclass(frozen=True)
class FactorMap:
    """factors = weights @ x; ``weights`` has a row per factor dimension."""

    weights: np.ndarray
    n_items: int


def normal_equations(rows: DataFrame, x_col: str = "x", y_col: str = "factors") -> tuple[np.ndarray, np.ndarray]:
    """(sum of x x', sum of x y') over all rows in one pass; sizes of both arrays from the first row."""
    first = rows.select(F.size(x_col), F.size(y_col)).first()
    if first is None:
        raise ValueError("no item has both features and factors")
    both = rows.select(array_to_vector(F.concat(x_col, F.col(y_col).cast("array<double>"))).alias("v"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(both, "v").select("v")).computeGramianMatrix().toArray()
    d = first[0]
    return gram[:d, :d], gram[:d, d : d + first[1]]


def fit_map(factors: DataFrame, features: DataFrame, ridge: float = 1.0, id_col: str = "book_id") -> FactorMap:
    """Ridge regression of every factor dimension on the features of the items that have factors."""
    # an array is estimated as one value: the features would be broadcast whole
    rows = features.hint("merge").join(factors, id_col)
    xx, xy = normal_equations(rows)
    n = int(round(xx[0, 0]))  # the intercept's square is 1 in every row
    penalty = ridge * np.eye(len(xx))
    penalty[0, 0] = 0.0
    weights, *_ = np.linalg.lstsq(xx + penalty, xy, rcond=None)
    return FactorMap(weights.T, n)


def map_factors(features: DataFrame, fitted: FactorMap, id_col: str = "book_id") -> DataFrame:
    """(id, factors) predicted from the features."""
    weights = F.lit([[float(w) for w in row] for row in fitted.weights])
    return features.select(id_col, F.transform(weights, lambda w: dot(w, F.col("x"))).alias("factors"))


def mean_factors(factors: DataFrame) -> list[float]:
    """The mean item: one value per dimension."""
    size = factors.select(F.size("factors")).first()[0]
    row = factors.agg(*[F.avg(F.col("factors")[k]).alias(f"f{k}") for k in range(size)]).first()
    return [float(v) for v in row]


def cold_pairs(train: DataFrame, heldout: DataFrame, cold: Column) -> DataFrame:
    """Held-out pairs of cold items that all three methods score: the user has warm history, the full model the item."""
    pairs = heldout.where(cold)
    known = MD.scorable_pairs(pairs, train)
    return known.join(train.where(~cold).select("user_id").distinct(), "user_id", "left_semi")


def cold_start_scores(
    train: DataFrame,
    heldout: DataFrame,
    features: DataFrame,
    cold: Column,
    params: MD.ALSParams = MD.ALSParams(),
    ridge: float = 1.0,
) -> DataFrame:
    """Cold pairs with ``mapped``, ``full`` and ``mean`` predictions.

    mapped and mean use the users' factors of a model that has not seen the cold
    items (a condition on ``book_id``); full is the model fitted on all of ``train``.
    """
    partial = MD.fit_als(train.where(~cold), params)
    full = MD.fit_als(train, params)
    known, users = item_factors(partial), user_factors(partial)
    fitted = fit_map(known, features, ridge)
    mapped = map_factors(features.where(cold), fitted)
    mean = F.lit(mean_factors(known))
    pairs = cold_pairs(train, heldout, cold).select("user_id", "book_id", "rating")
    scored = score_factors(pairs, users, mapped.hint("merge"), out="mapped")
    scored = score_factors(scored, user_factors(full), item_factors(full), out="full")
    u = users.select("user_id", F.col("factors").alias("_u"))
    return scored.join(u, "user_id").withColumn("mean", dot(F.col("_u"), mean)).drop("_u")


def cold_start_report(scores: DataFrame) -> DataFrame:
    """One row per method (mapped, full, mean): rmse, n_pairs, n_items over the same pairs."""
    methods = ("mapped", "full", "mean")
    error = lambda m: (F.col(m) - F.col("rating").cast("double"))
    agg = scores.agg(
        *[F.sqrt(F.avg(error(m) * error(m))).alias(m) for m in methods],
        F.count("*").alias("n_pairs"),
        F.countDistinct("book_id").alias("n_items"),
    )
    rows = F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("rmse")) for m in methods])
    return agg.select(F.explode(rows).alias("r"), "n_pairs", "n_items").select("r.*", "n_pairs", "n_items")
