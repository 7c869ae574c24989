"""Ties, duplicates, undefined metrics and seen items."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.operators import models as MD
from quire.operators import ranking as R
from quire.operators import text as T
from quire.plans import tune as TU
from quire.plans.evaluate import evaluate_topk
from quire.sources.schemas import RESULTS


def lists(spark, rows):
    return spark.createDataFrame(rows, "user_id int, book_id int, row_num int")


def test_duplicate_predictions_count_once(spark):
    pred = lists(spark, [(1, 1, 1), (1, 1, 2), (1, 2, 3)])
    truth = spark.createDataFrame([(1, 1), (1, 2)], "user_id int, book_id int")
    assert M.mean_average_precision(pred, truth).first()["map"] == 1.0
    scored = spark.createDataFrame(
        [(1, 1, 5.0, 4.0), (1, 1, 4.0, 4.0), (1, 2, 3.0, 4.0)],
        "user_id int, book_id int, prediction double, rating double",
    )
    m = evaluate_topk(scored, truth.withColumn("rating", F.lit(4.0)), k=5).first()
    assert (m["n_rows"], m["map"], m["coverage"]) == (2, 1.0, 1.0)


def test_undefined_metrics_never_win(spark):
    rows = [
        ("v", "s", 5, 1, 0.1, None, None, None, 0, 0),
        ("v", "s", 5, 2, 0.1, float("nan"), float("nan"), None, 0, 0),
        ("v", "s", 5, 3, 0.1, 1.5, 0.9, 1.0, 1, 1),
    ]
    best = TU.best_config(spark.createDataFrame(rows, RESULTS)).first()
    assert (best["best_rmse"], best["rmse_rank"], best["best_map"], best["map_rank"]) == (1.5, 3, 0.9, 3)
    assert TU.winner(spark.createDataFrame(rows, RESULTS)).rank == 3


@pytest.fixture(scope="module")
def tied(spark):
    """One user owns a third of the rows, all of one score."""
    hot = spark.range(3000).select(F.lit(0).alias("user_id"), F.col("id").cast("int").alias("book_id"),
                                   F.lit(0.0).alias("prediction"))
    rest = spark.range(6000).select(
        (F.col("id") % 50 + 1).cast("int").alias("user_id"), F.col("id").cast("int").alias("book_id"),
        (F.col("id") % 7).cast("double").alias("prediction"),
    )
    return hot.unionByName(rest).cache()


def test_rank_and_positions_equal_windows(tied):
    top = R.top_k(tied, 5, "prediction", method="rank", out="rk")
    w = Window.partitionBy("user_id").orderBy(F.desc("prediction"))
    want = tied.withColumn("rk", F.rank().over(w).cast("int")).where("rk <= 5")
    assert top.select(*want.columns).exceptAll(want).count() == 0 and top.count() == want.count()
    got = R.positions(top, "user_id", "rk", "book_id", out="pos")
    full = want.withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("rk", "book_id")))
    assert got.select(*full.columns).exceptAll(full).count() == 0 and got.count() == full.count()


def test_no_window_over_a_tied_group(tied):
    plan = R.positions(R.top_k(tied, 5, "prediction", out="rk"), "user_id", "rk")._jdf.queryExecution()
    windows = [x for x in plan.executedPlan().toString().splitlines() if " Window [" in x]
    for w in windows:  # the k first rows, the sub-range counts, or rows of one sub-range
        assert "_sub" in w or "_cnt" in w or "row_number" in w and "WindowGroupLimit" in plan.executedPlan().toString()


def test_als_blocks_are_a_constant(spark):
    als = MD.als_estimator(spark)
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == MD.ALSParams().blocks == 10


def test_seen_items_take_no_places(spark):
    rows = [(u, b, float((u * b) % 5 + 1)) for u in range(8) for b in range(20) if (u + b) % 3]
    train = spark.createDataFrame(rows, "user_id int, book_id int, rating double")
    model = MD.fit_als(train, MD.ALSParams(max_iter=2, rank=2))
    recs = MD.recommend_top_k(model, train, 4, seen=train)
    assert recs.join(train, ["user_id", "book_id"], "left_semi").count() == 0
    assert recs.groupBy("user_id").agg(F.max("pos").alias("m"), F.count("*").alias("n")).where("m <> 4 or n <> 4").count() == 0


def test_vocabulary_has_every_term_and_dense_ids(spark):
    tf = spark.range(5000).select((F.col("id") % 40).alias("doc_id"), F.concat(F.lit("t"), "id").alias("term"),
                                  F.lit(1).cast("long").alias("tf"))
    v = T.vocabulary(tf, 40)
    r = v.agg(F.count("*").alias("n"), F.countDistinct("term_id").alias("d"), F.min("term_id").alias("lo"),
              F.max("term_id").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (5000, 5000, 0, 4999)
