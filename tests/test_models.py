"""Model job invariants (scores are not compared with SQL)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quire.operators import blend as B
from quire.operators import models as MD
from quire.operators import split as S
from quire.session import scratch_path
from quire.sources import fixtures as FX
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def parts(spark):
    train, val, test = S.split_recipe(FX.interactions(spark, SF_SMALL))
    return train.cache(), val.cache(), test.cache()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.rmse > 0 and 0 <= r.map <= 1 and 0 <= r.coverage <= 1
    assert df.columns == E.entry(spark).columns


def test_als_scores_nonnegative_and_reproducible(parts):
    train, val, _ = parts
    p = MD.ALSParams(max_iter=5, rank=5, reg=0.1)
    a = MD.score(MD.fit_als(train, p), val, "a")
    b = MD.score(MD.fit_als(train.repartition(3), p), val, "b")
    j = a.join(b, ["user_id", "book_id"])
    assert j.where("a < 0").count() == 0
    assert j.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-4
    assert j.count() == val.count()


def test_unread_model_predicts_zero(parts):
    train, val, _ = parts
    m = MD.fit_als(B.unread_rows(train), MD.ALSParams(max_iter=5, rank=1, reg=0.0))
    pred = MD.score(m, B.unread_rows(val))
    assert pred.count() > 0
    assert pred.where("prediction != 0").count() == 0


def test_recommend_top_k_shape(parts):
    train, val, _ = parts
    model = MD.fit_als(train, MD.ALSParams(max_iter=3, rank=4))
    recs = MD.recommend_top_k(model, val, 7)
    per_user = recs.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct("book_id").alias("d"), F.max("pos").alias("m")
    )
    assert per_user.where("n != 7 or d != 7 or m != 7").count() == 0
    assert per_user.count() == val.select("user_id").distinct().count()
    # positions follow descending scores
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("pos")
    bad = recs.withColumn("prev", F.lag("prediction").over(w)).where("prev < prediction")
    assert bad.count() == 0


@pytest.mark.parametrize(
    "name", ["als_baseline", "grid_als", "final_eval", "recommend_all_items", "map_all_items"]
)
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0


def test_lr_grid_keeps_result_schema(spark):
    """The LR grid must not alter the shared results schema used by the ALS grids."""
    from pyspark.ml.linalg import Vectors

    from quire.plans import tune as TU
    from quire.sources.schemas import RESULTS

    feats = spark.createDataFrame(
        [(1, i, float(i % 5), Vectors.sparse(3, [i % 3], [1.0])) for i in range(12)],
        ["user_id", "book_id", "rating", "idf_features"],
    )
    before = RESULTS.simpleString()
    out = TU.lr_grid(spark, feats, feats, [0.1], [0.01], "t", k=5, max_iter=5)
    assert out.columns[-1] == "net" and out.count() == 1
    assert RESULTS.simpleString() == before


def test_evaluate_matches_spark_evaluators(spark, parts):
    """evaluate_topk == RegressionEvaluator on the top-k rows and RankingMetrics on lists."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.mllib.evaluation import RankingMetrics
    from pyspark.sql import Window

    from quire.operators import ranking as R
    from quire.plans.evaluate import evaluate_topk

    train, val, _ = parts
    pred = MD.score(MD.fit_als(train, MD.ALSParams(max_iter=3, rank=4)), val).cache()
    k = 3
    got = evaluate_topk(pred, val, k=k, relevant_min=4).first()

    top = R.top_k(pred, k, "prediction", method="rank", out="rk")
    rmse = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(top)
    assert got.rmse == pytest.approx(rmse, abs=1e-9)

    w = Window.partitionBy("user_id").orderBy("rk", "book_id")
    lists = (
        top.withColumn("pos", F.row_number().over(w))
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "book_id"))).alias("p"))
        .select("user_id", F.col("p.book_id").alias("pred"))
    )
    truth = val.where("rating >= 4").groupBy("user_id").agg(F.collect_set("book_id").alias("t"))
    pairs = lists.join(truth, "user_id").select("pred", "t").rdd.map(lambda r: (r[0], r[1]))
    assert got.map == pytest.approx(RankingMetrics(pairs).meanAveragePrecision, abs=1e-12)


def test_blocks_follow_the_ratings_and_stay_with_the_model(spark, parts):
    train, val, _ = parts
    base = MD.ALSParams(max_iter=2, rank=3)
    assert base.sized_for(5).blocks == 10 and base.sized_for(10**9).blocks == 500
    assert base.sized_for(1200, per_block=100).blocks == 12
    params = base.sized_for(train.count(), per_block=200)
    assert params.blocks > 10
    model = MD.fit_als(train, params)
    path = scratch_path(spark, "als-test")
    MD.save_als(model, params, path)
    loaded, kept = MD.load_als(spark, path)
    assert kept == params
    a, b = MD.score(model, val, "a"), MD.score(loaded, val, "b")
    assert a.join(b, ["user_id", "book_id"]).where("abs(a - b) > 1e-6").count() == 0


def test_regression_passes_run_over_merged_partitions(spark, monkeypatch):
    """Each task of a pass sends a whole gradient: many small partitions are merged."""
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.sparse(30, [i % 30], [1.0]), float(i % 5)) for i in range(600)]
    data = spark.createDataFrame(rows, ["idf_features", "rating"]).repartition(64)
    seen, real = [], MD.LinearRegression.fit
    monkeypatch.setattr(MD.LinearRegression, "fit", lambda self, d: seen.append(d.rdd.getNumPartitions()) or real(self, d))
    few = MD.fit_lr(data, 0.1, 0.01)
    assert few.summary.numInstances == 600
    assert seen == [spark.sparkContext.defaultParallelism]
    monkeypatch.setattr(MD, "LR_ROWS", 30)
    MD.fit_lr(data, 0.1, 0.01)
    assert seen[1] == 20
