"""B: projections, casts, filters, clamps, blends, text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket, typed_interactions
from quire.functions.text import clean_text as clean_expr
from quire.operators import blend as B
from quire.registry.common import _hb, interactions, parts, r6, scored, sql_with
from quire.sources import fixtures as FX

COLD_BUCKETS = 10  # one item bucket in ten is withheld from training (cold start)


def cold_item():
    """Items withheld from training in the cold-start fixtures (hash bucket 0 of 10)."""
    return hash_bucket("2020i", "book_id") % COLD_BUCKETS == 0


COLD_SQL = _hb("concat('2020i:', book_id)") + " % 10 = 0"


def project_alias(spark, sf_dir):
    m = FX.user_id_map(spark, sf_dir)
    return m.select(F.col("user_id_csv").alias("user_id"), F.col("user_id").alias("user_key"))


def typed(spark, sf_dir):
    raw = interactions(spark, sf_dir)
    as_strings = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return typed_interactions(as_strings)


def rename_prediction(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    out = B.rename_prediction(scored(val), "als_prediction")
    return out.select("user_id", "book_id", "rating", r6("als_prediction"))


def read_filter(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    return B.read_rows(val)


def nan_drop_read(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    return B.nan_drop_read(train.unionByName(val))


def clamp_zero(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    shifted = scored(val).withColumn("prediction", F.col("prediction") - 2.5)
    out = B.clamp_predictions(shifted)
    return out.select("user_id", "book_id", r6("prediction"))


# -- deterministic stand-ins for the three prediction sources of the blend ------


def review_score():
    """Text-derived stand-in for the review model's prediction."""
    return (F.length("review_text") % 600) / 100.0 - 0.5


def als_side(val):
    """ALS-like predictions: pairs whose item is warm (cold items are not scored)."""
    return scored(val.where(~cold_item()))


def review_side(spark, sf_dir, val):
    # scored where the texts are: the join moves scores alone
    rev = FX.reviews(spark, sf_dir).withColumn("prediction", review_score()).drop("review_text")
    joined = typed_interactions(val).join(rev, ["user_id", "book_id", "rating"])
    return B.clamp_predictions(joined)


def unread_side(val):
    return B.unread_rows(val).withColumn("prediction", F.lit(0.0))


def _float_rating(df):
    return df.withColumn("rating", F.col("rating").cast("float"))


def blend_two(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    val = _float_rating(val)
    out = B.blend_two(als_side(val), review_side(spark, sf_dir, val))
    return out.select(
        "user_id", "book_id", "rating",
        r6("als_prediction"), r6("review_prediction"), r6("total_prediction"),
    )


def blend_three(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    val = _float_rating(val)
    read = B.read_rows(val)
    out = B.blend_three(
        als_side(read), review_side(spark, sf_dir, read), unread_side(val)
    )
    return out.select(
        "user_id", "book_id", "rating",
        r6("als_prediction"), r6("review_prediction"), r6("unread_prediction"),
        r6("total_prediction"),
    )


def literal_fraction(spark, sf_dir):
    _, val, test = parts(spark, sf_dir)
    held = val.unionByName(test)
    return held.select("user_id").distinct().withColumn("fraction", F.lit(0.5))


def clean_text(spark, sf_dir):
    docs = FX.corpus(spark, sf_dir)
    return docs.select("doc_id", clean_expr("text").alias("clean_text"))


QUERIES = {
    "project_alias": project_alias,
    "typed_interactions": typed,
    "rename_prediction": rename_prediction,
    "read_filter": read_filter,
    "nan_drop_read": nan_drop_read,
    "clamp_zero": clamp_zero,
    "blend_two": blend_two,
    "blend_three": blend_three,
    "literal_fraction": literal_fraction,
    "clean_text": clean_text,
}

REVIEW_SCORE_SQL = "(length(review_text) % 600) / 100.0 - 0.5"

SIDES = {
    "valf": "select user_id, book_id, is_read, cast(rating as float) as rating from val",
    "als_side": f"""select user_id, book_id, rating,
                           cast((cast(user_id as bigint) * 7919 + cast(book_id as bigint) * 104729)
                                % 1000 as double) / 200 as als_prediction
                    from valf where not ({COLD_SQL})""",
    "review_side": f"""select v.user_id, v.book_id, v.rating,
                              case when {REVIEW_SCORE_SQL} < 0 then 0.0
                                   else {REVIEW_SCORE_SQL} end as review_prediction
                       from valf v join reviews r using (user_id, book_id, rating)""",
}

SIDES_READ = {
    "valf": SIDES["valf"],
    "als_side": SIDES["als_side"] + " and is_read <> 0",
    "review_side": SIDES["review_side"] + " where v.is_read <> 0",
    "unread_side": "select user_id, book_id, rating, cast(0.0 as double) as unread_prediction from valf "
    "where is_read = 0",
}

ORACLE = {
    "project_alias": """select cast(c_custkey as int) as user_id,
                               md5('u' || cast(c_custkey as varchar)) as user_key
                        from customer""",
    "typed_interactions": sql_with(
        """select user_id, book_id, is_read, cast(rating as float) as rating, is_reviewed
           from interactions""",
        "interactions",
    ),
    "rename_prediction": sql_with(
        """select user_id, book_id, rating, round(prediction, 6) as als_prediction
           from val_scored""",
        "val_scored",
    ),
    "read_filter": sql_with("select * from val where is_read <> 0", "val"),
    "nan_drop_read": sql_with(
        """select * from train where is_read <> 0
           union all select * from val where is_read <> 0""",
        "train",
        "val",
    ),
    "clamp_zero": sql_with(
        """select user_id, book_id,
                  round(case when prediction - 2.5 < 0 then 0.0 else prediction - 2.5 end, 6)
                      as prediction
           from val_scored""",
        "val_scored",
    ),
    "blend_two": sql_with(
        """select user_id, book_id, rating,
                  round(als_prediction, 6) as als_prediction,
                  round(review_prediction, 6) as review_prediction,
                  round(coalesce(review_prediction, als_prediction), 6) as total_prediction
           from als_side full outer join review_side using (user_id, book_id, rating)""",
        "val",
        "reviews",
        extra=SIDES,
    ),
    "blend_three": sql_with(
        """select user_id, book_id, rating,
                  round(als_prediction, 6) as als_prediction,
                  round(review_prediction, 6) as review_prediction,
                  round(unread_prediction, 6) as unread_prediction,
                  round(coalesce(review_prediction, als_prediction, unread_prediction), 6)
                      as total_prediction
           from als_side
           full outer join review_side using (user_id, book_id, rating)
           full outer join unread_side using (user_id, book_id, rating)""",
        "val",
        "reviews",
        extra=SIDES_READ,
    ),
    "literal_fraction": sql_with(
        """select distinct user_id, cast(0.5 as double) as fraction
           from (select * from val union all select * from test) h""",
        "val",
        "test",
    ),
    "clean_text": """select doc_id, lower(regexp_replace(text, '[,.:!"?;()#$~&]', '', 'g'))
                            as clean_text
                     from documents""",
}
