"""E: window ranks; F: top-k and sort/limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import ranking as R
from quire.registry.common import interactions, parts, r6, scored, sql_with


def rank_candidates(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 500, "prediction", method="rank", out="rank")
    return top.select("user_id", "book_id", r6("prediction"), "rank")


def row_number_candidates(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 500, "prediction", method="row_number", out="row_num")
    return top.select("user_id", "book_id", r6("prediction"), "row_num")


def rank_truth(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    return R.rank_by_value(val.select("user_id", "book_id", "rating"), out="true_row")


def running_list_size(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    return R.running_count(val.select("user_id", "book_id", "rating"), out="running_size")


def top_500(spark, sf_dir):
    train, _, _ = parts(spark, sf_dir)
    top = R.top_k(scored(train), 500, "prediction", method="rank", out="rank")
    return top.select("user_id", "book_id", r6("prediction"), "rank")


def top_25(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 25, "prediction", method="rank", out="row_num")
    return top.select("user_id", "book_id", r6("prediction"), "row_num")


def sort_limit(spark, sf_dir):
    inter = interactions(spark, sf_dir)
    return R.sort_limit(inter, 5, F.col("rating").desc(), "user_id", "book_id")


QUERIES = {
    "rank_candidates": rank_candidates,
    "row_number_candidates": row_number_candidates,
    "rank_truth": rank_truth,
    "running_list_size": running_list_size,
    "top_500": top_500,
    "top_25": top_25,
    "sort_limit": sort_limit,
}

_TRAIN_SCORED = {
    "train_scored": """select *, cast((cast(user_id as bigint) * 7919
                                     + cast(book_id as bigint) * 104729) % 1000 as double) / 200
                                 as prediction
                       from train"""
}

ORACLE = {
    "rank_candidates": sql_with(
        """select user_id, book_id, round(prediction, 6) as prediction, "rank"
           from (select *, cast(rank() over (partition by user_id order by prediction desc)
                                as int) as "rank" from val_scored) x
           where "rank" <= 500""",
        "val_scored",
    ),
    "row_number_candidates": sql_with(
        """select user_id, book_id, round(prediction, 6) as prediction, row_num
           from (select *, cast(row_number() over (partition by user_id
                                                   order by prediction desc, book_id)
                                as int) as row_num from val_scored) x
           where row_num <= 500""",
        "val_scored",
    ),
    "rank_truth": sql_with(
        """select user_id, book_id, rating,
                  cast(rank() over (partition by user_id order by rating desc) as int) as true_row
           from val""",
        "val",
    ),
    "running_list_size": sql_with(
        """select user_id, book_id, rating,
                  cast(count(*) over (partition by user_id order by rating desc
                                      range between unbounded preceding and current row)
                       as int) as running_size
           from val""",
        "val",
    ),
    "top_500": sql_with(
        """select user_id, book_id, round(prediction, 6) as prediction, "rank"
           from (select *, cast(rank() over (partition by user_id order by prediction desc)
                                as int) as "rank" from train_scored) x
           where "rank" <= 500""",
        "train",
        extra=_TRAIN_SCORED,
    ),
    "top_25": sql_with(
        """select user_id, book_id, round(prediction, 6) as prediction, row_num
           from (select *, cast(rank() over (partition by user_id order by prediction desc)
                                as int) as row_num from val_scored) x
           where row_num <= 25""",
        "val_scored",
    ),
    "sort_limit": sql_with(
        "select * from interactions order by rating desc, user_id, book_id limit 5",
        "interactions",
    ),
}
