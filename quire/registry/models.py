"""J: model jobs (ALS, LR) and C10 / A9.

Raw model scores depend on floating-point summation order and are not
compared with SQL; these queries expose deterministic projections instead
(the scored pair set, the prediction source chosen by the blend, the
non-negativity of scores, the exact zeros of the unread model).  Full-score
queries are registered without an oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.columns import typed_interactions
from quire.operators import blend as B
from quire.operators import models as MD
from quire.registry.common import parts, r6, sql_with
from quire.registry.scalar import COLD_SQL, cold_item
from quire.registry.text import review_features, token_lists_sql
from quire.session import scratch_path
from quire.sources import fixtures as FX

PARAMS = MD.ALSParams(max_iter=5, rank=10, reg=0.1)
UNREAD = MD.ALSParams(max_iter=5, rank=1, reg=0.0)
LR_REG, LR_NET = 0.1, 0.01


def _zero_safe(c):
    """Round to 6 decimals and normalise -0.0 to 0.0."""
    return (F.round(F.col(c).cast("double"), 6) + F.lit(0.0)).alias(c)


def als_baseline(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    pred = MD.score(MD.fit_als(train, PARAMS), val)
    return pred.select(
        "user_id", "book_id", "rating", F.col("prediction").between(0, 100).cast("int").alias("valid")
    )


def als_implicit(spark, sf_dir):
    """Implicit-feedback ALS (confidence from the rating, preferences 0/1).

    Scores are preferences, not ratings; the scored pair set equals the
    explicit model's (same cold-start rule), which is what the oracle checks.
    """
    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(train, MD.with_params(PARAMS, implicit=True, alpha=1.0))
    return MD.score(model, val).select("user_id", "book_id")


def scored_pairs(spark, sf_dir):
    """Cold-start drop: a model fitted without cold items scores only warm pairs."""
    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(train.where(~cold_item()), PARAMS)
    return MD.score(model, val).select("user_id", "book_id")


def als_read(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(B.read_rows(train), PARAMS)
    pred = MD.score(model, B.read_rows(val))
    return pred.select(
        "user_id", "book_id", (F.col("prediction") >= 0).cast("int").alias("nonneg")
    )


def als_unread(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(B.unread_rows(train), UNREAD)
    pred = MD.score(model, B.unread_rows(val))
    return pred.select("user_id", "book_id", _zero_safe("prediction"))


def read_union_scores(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    pred = MD.read_variant(train, val, PARAMS, UNREAD)
    return pred.select("user_id", "book_id", "is_read")


def _review_features(spark, sf_dir):
    """(train, val, test) rows and their features."""
    return parts(spark, sf_dir), review_features(spark, sf_dir)


def read_features(feats):
    """The features of read rows only, by their own flag: the combined variant learns from and scores these."""
    return B.read_rows(feats).drop("is_read")


def lr_elastic_net(spark, sf_dir):
    """Coefficients, finite fit and rows of the regression on the train reviews' features."""
    _, (tr_f, _, _) = _review_features(spark, sf_dir)
    s = MD.fit_lr(tr_f, LR_REG, LR_NET)
    fits = 0 <= s.summary.rootMeanSquaredError < 5 and s.summary.totalIterations > 0
    return spark.createDataFrame(
        [(int(s.numFeatures), int(s.summary.numInstances), int(fits))],
        "num_features int, n_reviews long, fits int",
    )


def lr_single_feature(spark, sf_dir):
    """One-feature regression without regularisation: equals ordinary least squares."""
    from pyspark.ml.feature import VectorAssembler

    lines = FX.load(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    data = VectorAssembler(inputCols=["l_quantity"], outputCol="x").transform(lines)
    model = MD.fit_lr(data, 0.0, 0.0, features_col="x", label_col="l_extendedprice",
                      solver="normal")
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 4))],
        "slope double, intercept double",
    )


def review_scores(spark, sf_dir):
    _, (tr_f, va_f, _) = _review_features(spark, sf_dir)
    pred = MD.review_predictions(MD.fit_lr(tr_f, LR_REG, LR_NET), va_f)
    return pred.select(
        "user_id", "book_id", "rating", (F.col("prediction") >= 0).cast("int").alias("nonneg")
    )


def _source(cols):
    expr = None
    for c in cols:
        cond = F.col(f"{c}_prediction").isNotNull()
        expr = F.when(cond, F.lit(c)) if expr is None else expr.when(cond, F.lit(c))
    return expr.alias("source")


def review_blend_scores(spark, sf_dir):
    (train, val, _), (tr_f, va_f, _) = _review_features(spark, sf_dir)
    review = MD.review_predictions(MD.fit_lr(tr_f, LR_REG, LR_NET), va_f)
    als = MD.score(MD.fit_als(train, PARAMS), typed_interactions(val))
    blended = B.blend_two(als, review)
    return blended.select("user_id", "book_id", "rating", _source(["review", "als"]))


def combined_scores(spark, sf_dir):
    (train, val, _), (tr_f, va_f, _) = _review_features(spark, sf_dir)
    valt = typed_interactions(val)
    review = MD.review_predictions(
        MD.fit_lr(read_features(tr_f), LR_REG, LR_NET), read_features(va_f)
    )
    als = MD.score(MD.fit_als(B.read_rows(train), PARAMS), B.read_rows(valt))
    unread = MD.score(MD.fit_als(B.unread_rows(train), UNREAD), B.unread_rows(valt))
    blended = B.blend_three(als, review, unread)
    return blended.select(
        "user_id", "book_id", "rating", _source(["review", "als", "unread"])
    )


def recommend_all_items(spark, sf_dir, k: int = 500):
    """The best unseen items of every held-out user: a full list each, no training pair in it."""
    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(train, PARAMS)
    recs = MD.recommend_top_k(model, val, k, seen=train)
    known = train.select("user_id", "book_id", F.lit(1).alias("known"))
    return (
        recs.join(known, ["user_id", "book_id"], "left")
        .groupBy("user_id")
        .agg(
            F.count("*").alias("n_items"),
            F.max("pos").alias("last_pos"),
            F.count("known").alias("n_seen"),
        )
    )


def map_all_items(spark, sf_dir, k: int = 500):
    """All-items protocol: top-500 over the catalogue vs relevant held-out pairs."""
    from quire.plans.evaluate import evaluate_all_items

    train, val, _ = parts(spark, sf_dir)
    model = MD.fit_als(train, PARAMS)
    m = evaluate_all_items(model, val, k=k, relevant_min=4, seen=train)
    inside = lambda c: F.col(c).between(0, 1).cast("int").alias(f"{c}_valid")
    return m.select("n_users", *[inside(c) for c in m.columns if c != "n_users"])


def model_roundtrip(spark, sf_dir):
    """Save the fitted model and its parameters to the shared folder, load them, and compare scores."""
    train, val, _ = parts(spark, sf_dir)
    params = PARAMS.sized_for(train.count())
    model = MD.fit_als(train, params)
    path = scratch_path(spark, "als-model")
    MD.save_als(model, params, path)
    loaded, kept = MD.load_als(spark, path)
    if kept != params:
        raise ValueError("the model came back with other parameters")
    a = MD.score(model, val, "p1").select("user_id", "book_id", "p1")
    b = MD.score(loaded, val, "p2").select("user_id", "book_id", "p2")
    return a.join(b, ["user_id", "book_id"]).select(
        "user_id", "book_id", (F.abs(F.col("p1") - F.col("p2")) < 1e-6).cast("int").alias("same")
    )


QUERIES = {
    "als_baseline": als_baseline,
    "als_implicit": als_implicit,
    "scored_pairs": scored_pairs,
    "als_read": als_read,
    "als_unread": als_unread,
    "read_union_scores": read_union_scores,
    "lr_elastic_net": lr_elastic_net,
    "lr_single_feature": lr_single_feature,
    "review_scores": review_scores,
    "review_blend_scores": review_blend_scores,
    "combined_scores": combined_scores,
    "recommend_all_items": recommend_all_items,
    "map_all_items": map_all_items,
    "model_roundtrip": model_roundtrip,
}

_REV_VAL = """select v.user_id, v.book_id, v.is_read, cast(v.rating as float) as rating
              from val v join reviews r
                on v.user_id = r.user_id and v.book_id = r.book_id
               and cast(v.rating as float) = r.rating"""

ORACLE = {
    "als_baseline": sql_with(
        """select user_id, book_id, rating, 1 as valid from val
           where user_id in (select user_id from train) and book_id in (select book_id from train)""",
        "train",
        "val",
    ),
    "lr_elastic_net": sql_with(
        """select cast((select count(distinct term) from train_terms) as int) as num_features,
                  (select count(*) from train_rev) as n_reviews, 1 as fits""",
        "train",
        "reviews",
        "stop_words",
        extra={
            "train_rev": """select t.user_id, t.book_id, r.rating, r.review_text
                            from train t join reviews r
                              on t.user_id = r.user_id and t.book_id = r.book_id
                             and cast(t.rating as float) = r.rating""",
            "train_tokens": token_lists_sql("train_rev", "user_id, book_id"),
            "train_terms": """select term from (select unnest(tokens) as term from train_tokens) x
                              where term not in (select word from stop_words)""",
        },
    ),
    "recommend_all_items": sql_with(
        """select user_id, least(n, 500) as n_items, cast(least(n, 500) as int) as last_pos, cast(0 as bigint) as n_seen
           from (select v.user_id, (select count(distinct book_id) from train)
                                   - count(distinct t.book_id) as n
                 from (select distinct user_id from val) v join train t using (user_id)
                 group by v.user_id) x
           where n > 0""",
        "train",
        "val",
    ),
    "map_all_items": sql_with(
        """select count(distinct user_id) as n_users, 1 as map_valid, 1 as map_at_k_valid,
                  1 as precision_at_k_valid, 1 as recall_at_k_valid, 1 as ndcg_at_k_valid
           from val where rating >= 4 and user_id in (select user_id from train)""",
        "train",
        "val",
    ),
    "scored_pairs": sql_with(
        """select user_id, book_id from val
           where user_id in (select user_id from warm) and book_id in (select book_id from warm)""",
        "train",
        "val",
        extra={"warm": f"select * from train where not ({COLD_SQL})"},
    ),
    "als_read": sql_with(
        """select user_id, book_id, 1 as nonneg from val
           where is_read <> 0
             and user_id in (select user_id from train where is_read <> 0)
             and book_id in (select book_id from train where is_read <> 0)""",
        "train",
        "val",
    ),
    "als_unread": sql_with(
        """select user_id, book_id, cast(0.0 as double) as prediction from val
           where is_read = 0
             and user_id in (select user_id from train where is_read = 0)
             and book_id in (select book_id from train where is_read = 0)""",
        "train",
        "val",
    ),
    "read_union_scores": sql_with(
        """select user_id, book_id, is_read from val
           where is_read <> 0
             and user_id in (select user_id from train where is_read <> 0)
             and book_id in (select book_id from train where is_read <> 0)
           union all
           select user_id, book_id, is_read from val
           where is_read = 0
             and user_id in (select user_id from train where is_read = 0)
             and book_id in (select book_id from train where is_read = 0)""",
        "train",
        "val",
    ),
    "lr_single_feature": """select round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
                                   round(regr_intercept(l_extendedprice, l_quantity), 4)
                                       as intercept
                            from lineitem""",
    "review_scores": sql_with(
        "select user_id, book_id, rating, 1 as nonneg from rev_val",
        "val",
        "reviews",
        extra={"rev_val": _REV_VAL},
    ),
    "review_blend_scores": sql_with(
        """select user_id, book_id, rating,
                  case when r.user_id is not null then 'review' else 'als' end as source
           from (select user_id, book_id, cast(rating as float) as rating from val
                 where user_id in (select user_id from train)
                   and book_id in (select book_id from train)) a
           full outer join (select user_id, book_id, rating from rev_val) r
           using (user_id, book_id, rating)""",
        "train",
        "val",
        "reviews",
        extra={"rev_val": _REV_VAL},
    ),
    "combined_scores": sql_with(
        """select user_id, book_id, rating,
                  case when r.user_id is not null then 'review'
                       when a.user_id is not null then 'als'
                       else 'unread' end as source
           from (select user_id, book_id, cast(rating as float) as rating from val
                 where is_read <> 0
                   and user_id in (select user_id from train where is_read <> 0)
                   and book_id in (select book_id from train where is_read <> 0)) a
           full outer join (select user_id, book_id, rating from rev_val
                            where is_read <> 0) r
             using (user_id, book_id, rating)
           full outer join (select user_id, book_id, cast(rating as float) as rating from val
                            where is_read = 0
                              and user_id in (select user_id from train where is_read = 0)
                              and book_id in (select book_id from train where is_read = 0)) u
             using (user_id, book_id, rating)""",
        "train",
        "val",
        "reviews",
        extra={"rev_val": _REV_VAL},
    ),
    "als_implicit": sql_with(
        """select user_id, book_id from val
           where user_id in (select user_id from train) and book_id in (select book_id from train)""",
        "train",
        "val",
    ),
    "model_roundtrip": sql_with(
        """select user_id, book_id, 1 as same from val
           where user_id in (select user_id from train) and book_id in (select book_id from train)""",
        "train",
        "val",
    ),
}
