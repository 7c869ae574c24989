"""A hot user owning about a third of all rows: skew-safe operators stay exact and
never window or sort over the whole user group."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket
from quire.operators import ranking as R
from quire.operators import split as S
from quire.plans.evaluate import evaluate_topk
from quire.sources import fixtures as FX
from tests.conftest import SF_CHECK

HOT = 0


@pytest.fixture(scope="module")
def skewed(spark):
    inter = FX.interactions(spark, SF_CHECK)
    hot = hash_bucket("hot", "user_id", "book_id") % 3 == 0
    # (user, book) -> (HOT, book * 20000 + user) keeps pairs unique
    return inter.select(
        F.when(hot, F.lit(HOT)).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, F.col("book_id") * 20000 + F.col("user_id"))
        .otherwise(F.col("book_id"))
        .alias("book_id"),
        "is_read",
        "rating",
        "is_reviewed",
    ).cache()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_share(skewed):
    n = skewed.count()
    hot = skewed.where(F.col("user_id") == HOT).count()
    assert 0.3 < hot / n < 0.37


def test_rank_by_value_exact_under_skew(skewed):
    got = R.rank_by_value(skewed.select("user_id", "book_id", "rating"))
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc())
    want = skewed.select("user_id", "book_id", "rating", F.rank().over(w).alias("true_row"))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == skewed.count()
    # the only windows run over the (user, rating) histogram, not over rows
    assert "Window [rank(" not in _plan(got)


def test_exact_half_exact_under_skew(skewed):
    got = S.exact_half(skewed)
    h = hash_bucket(2020, "user_id", "book_id")
    w = Window.partitionBy("user_id").orderBy(h, "book_id")
    n = F.count("*").over(Window.partitionBy("user_id"))
    want = skewed.select(
        *skewed.columns,
        F.when(F.row_number().over(w) <= F.ceil(n / 2.0), 0).otherwise(1).alias("half"),
    )
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    plan = _plan(got)
    # row numbers are windowed per (user, hash sub-range)
    assert "row_number()" in plan and "[user_id#" in plan and "_sub#" in plan


def test_top_k_and_metrics_bounded_under_skew(skewed):
    scored = skewed.withColumn("prediction", FX.score())
    top = R.top_k(scored, 20, "prediction", method="row_number")
    per_user = top.groupBy("user_id").count()
    assert per_user.agg(F.max("count")).first()[0] == 20
    plan = _plan(top)
    ex = plan.find("Exchange hashpartitioning(user_id")
    assert ex > 0 and ", Partial" in plan[ex:ex + 400]
    m = evaluate_topk(scored, skewed, k=20, relevant_min=4).first()
    assert m.n_users == skewed.select("user_id").distinct().count()
    assert 0 <= m.map <= 1 and 0 <= m.coverage <= 1
