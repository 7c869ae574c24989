"""D: counts, distincts, profiles, ordered lists, describe, crosstab."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import profile as P
from quire.operators import ranking as R
from quire.registry.common import interactions, parts, r6, scored, sql_with

RATINGS = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
DESCRIBED = ("user_id", "book_id", "is_read", "rating", "is_reviewed")


def row_count(spark, sf_dir):
    return interactions(spark, sf_dir).agg(F.count("*").alias("n_rows"))


def distinct_users(spark, sf_dir):
    return interactions(spark, sf_dir).select("user_id").distinct()


def profile(spark, sf_dir):
    return P.profile(interactions(spark, sf_dir))


def _joined(c):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",").alias(c)


def user_item_list(spark, sf_dir):
    """Per-user top-5 prediction list (bounded by k), ordered by position."""
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 5, "prediction", method="row_number", out="row_num")
    lists = R.ordered_list(top, pos_col="row_num", out="books")
    return lists.select("user_id", _joined("books"), F.size("books").alias("n_books"))


def ordered_list(spark, sf_dir):
    """Every user's whole truth list by rating rank, in long form with its size.

    A user's list is not collected into a row: it has no bound.
    """
    _, val, test = parts(spark, sf_dir)
    held = val.unionByName(test).select("user_id", "book_id", "rating")
    ranked = R.rank_by_value(held, out="true_row")
    sizes = held.groupBy("user_id").agg(F.count("*").cast("int").alias("n_books"))
    return (
        R.positions(ranked, "user_id", "true_row", out="pos")
        .join(sizes, "user_id")
        .select("user_id", "pos", "book_id", "n_books")
    )


def describe(spark, sf_dir):
    out = P.describe(interactions(spark, sf_dir), DESCRIBED)
    return out.select(*[r6(c) if not c.endswith("_count") else F.col(c) for c in out.columns])


def read_rating_crosstab(spark, sf_dir):
    return P.crosstab(interactions(spark, sf_dir), "is_read", "rating", RATINGS)


def user_counts(spark, sf_dir):
    return P.user_counts(interactions(spark, sf_dir), 5)


QUERIES = {
    "row_count": row_count,
    "distinct_users": distinct_users,
    "profile": profile,
    "user_item_list": user_item_list,
    "ordered_list": ordered_list,
    "describe": describe,
    "read_rating_crosstab": read_rating_crosstab,
    "user_counts": user_counts,
}

_DESC = ", ".join(
    f"count({c}) as {c}_count, round(avg({c}), 6) as {c}_mean, "
    f"round(stddev_samp({c}), 6) as {c}_stddev, round(cast(min({c}) as double), 6) as {c}_min, "
    f"round(cast(max({c}) as double), 6) as {c}_max"
    for c in DESCRIBED
)

ORACLE = {
    "row_count": sql_with("select count(*) as n_rows from interactions", "interactions"),
    "distinct_users": sql_with("select distinct user_id from interactions", "interactions"),
    "profile": sql_with(
        """select count(*) as n_ratings, count(distinct user_id) as n_users,
                  count(distinct book_id) as n_books from interactions""",
        "interactions",
    ),
    "user_item_list": sql_with(
        """select user_id, string_agg(cast(book_id as varchar), ',' order by pos) as books,
                  cast(count(*) as int) as n_books
           from (select *, row_number() over (partition by user_id
                                              order by prediction desc, book_id) as pos
                 from val_scored) x
           where pos <= 5 group by user_id""",
        "val_scored",
    ),
    "ordered_list": sql_with(
        """select user_id,
                  cast(row_number() over (partition by user_id order by rating desc, book_id) as int) as pos,
                  book_id, cast(count(*) over (partition by user_id) as int) as n_books
           from (select * from val union all select * from test) h""",
        "val",
        "test",
    ),
    "describe": sql_with(f"select {_DESC} from interactions", "interactions"),
    "read_rating_crosstab": sql_with(
        "select is_read, "
        + ", ".join(
            f"count(*) filter (where rating = {v}) as r{i}" for i, v in enumerate(RATINGS)
        )
        + ", count(*) filter (where rating is not null and rating not in ("
        + ", ".join(str(v) for v in RATINGS)
        + ")) as r_other, count(*) filter (where rating is null) as r_null"
        + " from interactions group by is_read",
        "interactions",
    ),
    "user_counts": sql_with(
        """select user_id, count(*) as count from interactions
           group by user_id order by user_id limit 5""",
        "interactions",
    ),
}
