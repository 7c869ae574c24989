"""G: unions and EXCEPT."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import blend as B
from quire.operators import split as S
from quire.registry.common import ICOLS, interactions, parts, r6, scored, sql_with


def union_train(spark, sf_dir):
    rows = S.with_split_columns(interactions(spark, sf_dir))
    cols = ICOLS.split(", ")
    train_users = rows.where(F.col("part") == "train").select(*cols)
    val_obs = rows.where((F.col("part") == "val") & (F.col("half") == 0)).select(*cols)
    test_obs = rows.where((F.col("part") == "test") & (F.col("half") == 0)).select(*cols)
    return S.union_observed(train_users, val_obs, test_obs)


def union_predictions(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    read = scored(B.read_rows(val))
    unread = B.unread_rows(val).withColumn("prediction", F.lit(0.0))
    out = B.union_predictions(read, unread)
    return out.select(*[r6(c) if c == "prediction" else F.col(c) for c in out.columns])


def held_out_except(spark, sf_dir):
    rows = S.with_split_columns(interactions(spark, sf_dir)).where(F.col("part") != "train")
    cols = ICOLS.split(", ")
    observed = rows.where(F.col("half") == 0).select(*cols)
    return S.held_out_except(rows.select(*cols), observed)


def unread_except(spark, sf_dir):
    train, val, test = parts(spark, sf_dir)
    return B.unread_except(train.unionByName(val).unionByName(test))


QUERIES = {
    "union_train": union_train,
    "union_predictions": union_predictions,
    "held_out_except": held_out_except,
    "unread_except": unread_except,
}

ORACLE = {
    "union_train": sql_with("select * from train", "train"),
    "union_predictions": sql_with(
        """select user_id, book_id, is_read, rating, is_reviewed, round(prediction, 6) as prediction
           from val_scored where is_read <> 0
           union all
           select user_id, book_id, is_read, rating, is_reviewed, 0.0 as prediction
           from val where is_read = 0""",
        "val_scored",
    ),
    "held_out_except": sql_with(
        f"""select {ICOLS} from split_rows where part <> 'train'
            except
            select {ICOLS} from split_rows where part <> 'train' and half = 0""",
        "split_rows",
    ),
    "unread_except": sql_with(
        """select * from (select * from train union all select * from val union all select * from test) r
           except select * from (select * from train union all select * from val
                                 union all select * from test) r where is_read <> 0""",
        "train",
        "val",
        "test",
    ),
}
