"""C: id mapping, composite-key joins, outer joins of prediction sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.columns import typed_interactions
from quire.operators import blend as B
from quire.operators import ranking as R
from quire.registry.common import parts, r6, scored, sql_with
from quire.registry.scalar import SIDES, SIDES_READ, als_side, review_side, unread_side
from quire.session import scratch_path
from quire.sources import fixtures as FX
from quire.sources import io, schemas


def map_ids(raw_reviews, user_map, book_map):
    """Replace opaque string ids with numeric ones via two dimension joins.

    The maps meet the pairs of ids; the texts travel once, to their pair, and are not sorted.
    """
    ids = raw_reviews.select("user_id", "book_id").distinct().join(user_map, "user_id").join(book_map, "book_id")
    joined = raw_reviews.join(ids.hint("shuffle_hash"), ["user_id", "book_id"])
    return joined.select(
        F.col("user_id_csv").alias("user_id"),
        F.col("book_id_csv").alias("book_id"),
        F.col("rating").cast("float").alias("rating"),
        "review_text",
        "review_id",
    )


def id_mapping(spark, sf_dir):
    """The id maps are read from CSV files with a header, as they are delivered."""
    path = scratch_path(spark, "id-maps")
    maps = []
    for name, df, schema in (
        ("users", FX.user_id_map(spark, sf_dir), schemas.USER_ID_MAP),
        ("books", FX.book_id_map(spark, sf_dir), schemas.BOOK_ID_MAP),
    ):
        io.write_csv(df, f"{path}/{name}")
        maps.append(io.read_csv(spark, f"{path}/{name}", schema))
    return map_ids(FX.raw_reviews(spark, sf_dir), *maps)


def review_composite_join(spark, sf_dir):
    rev = FX.reviews(spark, sf_dir)
    out = None
    for name, rows in zip(("train", "val", "test"), parts(spark, sf_dir), strict=True):
        joined = typed_interactions(rows).join(rev, ["user_id", "book_id", "rating"])
        one = joined.select(F.lit(name).alias("part"), "review_text", "rating", "user_id", "book_id")
        out = one if out is None else out.unionByName(one)
    return out


def outer_two(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    val = val.withColumn("rating", F.col("rating").cast("float"))
    out = B.outer_two(als_side(val), review_side(spark, sf_dir, val))
    return out.select("user_id", "book_id", "rating", r6("als_prediction"), r6("review_prediction"))


def outer_three(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    val = val.withColumn("rating", F.col("rating").cast("float"))
    read = B.read_rows(val)
    out = B.outer_three(als_side(read), review_side(spark, sf_dir, read), unread_side(val))
    return out.select(
        "user_id", "book_id", "rating",
        r6("als_prediction"), r6("review_prediction"), r6("unread_prediction"),
    )


def pred_truth_join(spark, sf_dir):
    """Per-user top-5 prediction list joined with the relevant-truth list (sizes)."""
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 5, "prediction", method="row_number", out="row_num")
    pred = R.ordered_list(top, pos_col="row_num", out="pred")
    truth = (
        val.where(F.col("rating") >= 4)
        .groupBy("user_id")
        .agg(F.count("*").cast("int").alias("n_truth"))
    )
    return pred.join(truth, "user_id").select(
        "user_id", F.size("pred").alias("n_pred"), "n_truth"
    )


QUERIES = {
    "id_mapping": id_mapping,
    "review_composite_join": review_composite_join,
    "outer_two": outer_two,
    "outer_three": outer_three,
    "pred_truth_join": pred_truth_join,
}

ORACLE = {
    "id_mapping": sql_with("select * from reviews", "reviews"),
    "review_composite_join": sql_with(
        """select part, r.review_text, r.rating, t.user_id, t.book_id
           from (select 'train' as part, * from train union all select 'val' as part, * from val
                 union all select 'test' as part, * from test) t
           join reviews r
             on t.user_id = r.user_id and t.book_id = r.book_id
            and cast(t.rating as float) = r.rating""",
        "train",
        "val",
        "test",
        "reviews",
    ),
    "outer_two": sql_with(
        """select user_id, book_id, rating,
                  round(als_prediction, 6) as als_prediction,
                  round(review_prediction, 6) as review_prediction
           from als_side full outer join review_side using (user_id, book_id, rating)""",
        "val",
        "reviews",
        extra=SIDES,
    ),
    "outer_three": sql_with(
        """select user_id, book_id, rating,
                  round(als_prediction, 6) as als_prediction,
                  round(review_prediction, 6) as review_prediction,
                  round(unread_prediction, 6) as unread_prediction
           from als_side
           full outer join review_side using (user_id, book_id, rating)
           full outer join unread_side using (user_id, book_id, rating)""",
        "val",
        "reviews",
        extra=SIDES_READ,
    ),
    "pred_truth_join": sql_with(
        """select p.user_id, cast(least(p.n, 5) as int) as n_pred, cast(t.n as int) as n_truth
           from (select user_id, count(*) as n from val group by user_id) p
           join (select user_id, count(*) as n from val where rating >= 4 group by user_id) t
             using (user_id)""",
        "val",
    ),
}
