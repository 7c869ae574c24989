"""Evaluation job: one ranked table per user gives RMSE, MAP and coverage at every cutoff.

A user's rows are ranked once, up to the largest cutoff; rank and position of a
row do not depend on the cutoff, so every smaller one is a sum over the rows
whose rank it admits.  Rows of one score and a range of 1,024 items are
packed before the ranking window, so a user whose scores are one large tie is
ranked by its ranges, not by its rows.  Several configurations' predictions are
evaluated in one job by passing their key columns as ``config_cols`` (e.g. a union
of predictions, or one scorer expanded over a parameter array); no
users x configurations product is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: items of a range: rows of equal score are packed by ``book_id`` >> this
RANGE_BITS = 10


def _truth(heldout: DataFrame, label_col: str, relevant_min: float | None) -> DataFrame:
    """(user_id, book_id, _rel): distinct held-out pairs, 1 where relevant."""
    rel = F.lit(True) if relevant_min is None else F.coalesce(F.col(label_col) >= relevant_min, F.lit(False))
    return heldout.groupBy("user_id", "book_id").agg(F.max(rel.cast("int")).alias("_rel"))


def ranked_ranges(predictions: DataFrame, truth: DataFrame, k: int, grp: list[str],
                  prediction_col: str, label_col: str) -> DataFrame:
    """Packed rows with a rank of at most ``k``: grp, _rank, _cnt, _se, _aps.

    A packed row holds a user's rows of one score and one range of items: their
    number, summed squared errors and summed precision at the relevant ones.
    """
    # one exchange by pair serves the deduplication and the join with the truth
    best = F.max(F.struct(F.col(prediction_col), F.col(label_col)))
    once = (
        predictions.repartition("user_id", "book_id")
        .groupBy(*grp, "book_id")
        .agg(best.alias("_best"))
        .select(*grp, "book_id", F.col(f"_best.{prediction_col}").alias("_score"),
                F.col(f"_best.{label_col}").alias("_label"))
    )
    flagged = once.join(truth, ["user_id", "book_id"], "left")
    err = F.col("_score").cast("double") - F.col("_label").cast("double")
    packed = flagged.groupBy(*grp, "_score", F.shiftright("book_id", RANGE_BITS).alias("_sub")).agg(
        F.sort_array(F.collect_list(F.struct("book_id", F.coalesce("_rel", F.lit(0)).alias("rel")))).alias("_all"),
        F.count("*").alias("_cnt"),
        F.sum(err * err).alias("_se"),
    )
    places = F.filter(
        F.transform("_all", lambda x, i: F.when(x["rel"] == 1, i + 1)), lambda p: p.isNotNull()
    )
    packed = packed.select(*grp, "_score", "_sub", "_cnt", "_se", places.alias("_hits"))
    # rank <= k implies dense_rank <= k: the limit runs before the exchange by user
    by_score = Window.partitionBy(*grp).orderBy(F.col("_score").desc())
    some = packed.withColumn("_dense", F.dense_rank().over(by_score)).where(F.col("_dense") <= k)
    order = Window.partitionBy(*grp).orderBy(F.col("_score").desc(), "_sub")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = some.select(
        "*",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.coalesce(F.sum(F.size("_hits")).over(before), F.lit(0)).alias("_found"),
        (F.coalesce(F.lag("_dense").over(order), F.lit(0)) != F.col("_dense")).alias("_first"),
    )
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    ranked = offsets.withColumn(
        "_rank", F.last(F.when(F.col("_first"), F.col("_off")), ignorenulls=True).over(upto) + 1
    ).where(F.col("_rank") <= k)
    precision = F.transform("_hits", lambda p, j: (F.col("_found") + j + 1) / (F.col("_off") + p))
    aps = F.aggregate(precision, F.lit(0.0), lambda s, x: s + x)
    return ranked.select(*grp, "_rank", "_cnt", "_se", aps.alias("_aps"))


def evaluate_cutoffs(
    predictions: DataFrame,
    heldout: DataFrame,
    ks: tuple[int, ...] = (500,),
    prediction_col: str = "prediction",
    label_col: str = "rating",
    relevant_min: float | None = None,
    config_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Per configuration and cutoff k: rmse, n_rows, map, n_map_users, coverage, n_users.

    * a (user, item) pair predicted several times counts once, with its best score;
    * rmse over the rows of rank k or better (ties included, as the original);
    * map: list positions by (rank, item); truth = held-out pairs (optionally
      only ``rating >= relevant_min``); users present in both, as the
      original's inner join;
    * coverage: mean over *all* held-out users of |top-k pairs| / |held-out
      pairs| (users without predictions count 0).
    """
    cfg = list(config_cols)
    grp = cfg + ["user_id"]
    truth = _truth(heldout, label_col, relevant_min)
    held = truth.groupBy("user_id").agg(F.count("*").alias("_nh"), F.sum("_rel").alias("_rel"))
    held = held.select("user_id", "_nh", F.when(F.col("_rel") > 0, F.col("_rel")).alias("_nt"))
    n_users = heldout.select("user_id").distinct().select(F.count("*")).scalar()
    ranges = ranked_ranges(predictions, truth, max(ks), grp, prediction_col, label_col)
    of = lambda k, c: F.sum(F.when(F.col("_rank") <= k, F.col(c)))
    per_user = ranges.groupBy(*grp).agg(
        *[of(k, c).alias(f"{c}{j}") for j, k in enumerate(ks) for c in ("_se", "_cnt", "_aps")]
    ).join(held, "user_id", "left")
    has_truth = F.col("_nt").isNotNull()
    totals = []
    for j, _ in enumerate(ks):
        n = F.col(f"_cnt{j}")
        totals += [
            F.sqrt(F.sum(f"_se{j}") / F.sum(n)).alias(f"rmse{j}"),
            F.sum(n).alias(f"n_rows{j}"),
            F.avg(F.when(has_truth, F.col(f"_aps{j}") / F.col("_nt"))).alias(f"map{j}"),
            F.sum(F.when(F.col("_nh").isNotNull(), n / F.col("_nh"))).alias(f"_cov{j}"),
        ]
    agg = per_user.groupBy(*cfg).agg(F.count(F.when(has_truth, 1)).alias("n_map_users"), *totals)
    rows = F.array(*[
        F.struct(F.lit(k).alias("k"), *[F.col(f"{c}{j}").alias(c) for c in ("rmse", "n_rows", "map", "_cov")])
        for j, k in enumerate(ks)
    ])
    users = F.lit(n_users)
    return agg.select(*cfg, "n_map_users", F.explode(rows).alias("r")).select(
        *cfg, "r.k", "r.rmse", "r.n_rows", "r.map", "n_map_users",
        (F.coalesce(F.col("r._cov"), F.lit(0.0)) / users).alias("coverage"), users.alias("n_users"),
    )


def evaluate_topk(predictions: DataFrame, heldout: DataFrame, k: int = 500, **options) -> DataFrame:
    """``evaluate_cutoffs`` at one cutoff, without the column k."""
    return evaluate_cutoffs(predictions, heldout, (k,), **options).drop("k")


def evaluate_all_items(
    model,
    heldout: DataFrame,
    k: int = 500,
    relevant_min: float | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The all-items protocol: top-k over the whole catalogue vs held-out truth.

    Unlike the held-out-candidates protocol (whose MAP equals coverage), every
    catalogue item competes, so this measures ranking quality.  One row:
    map, map_at_k, precision_at_k, recall_at_k, ndcg_at_k, n_users.  Pairs in
    ``seen`` (usually the training pairs) are not recommended again.
    """
    from quire.operators import metrics as M
    from quire.operators import models as MD

    recs = MD.recommend_top_k(model, heldout, k, seen=seen)
    truth = heldout if relevant_min is None else heldout.where(F.col("rating") >= relevant_min)
    return M.ranking_metrics(recs, truth.select("user_id", "book_id"), k=k, pos_col="pos")
