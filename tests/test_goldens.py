"""Golden numbers at sf0.01 (FIXTURES.md section 3), computed with the library."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket
from quire.operators import metrics as M
from quire.operators import profile as P
from quire.operators import ranking as R
from quire.operators import split as S
from quire.operators import text as T
from quire.sources import fixtures as FX
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def inter(spark):
    return FX.interactions(spark, SF_CHECK).cache()


def test_interaction_profile(inter):
    row = P.profile(inter).first()
    assert (row.n_ratings, row.n_users, row.n_books) == (59391, 1500, 2000)
    agg = inter.agg(
        F.sum(F.when(F.col("is_read") == 1, 1).otherwise(0)).alias("read"),
        F.sum("is_reviewed").alias("reviewed"),
        F.sum("rating").alias("sum_rating"),
        F.sum(F.col("user_id") * 7 + F.col("book_id") * F.col("rating")).alias("chk"),
    ).first()
    assert (agg.read, agg.reviewed) == (39818, 2978)
    assert agg.sum_rating == 119233
    assert agg.chk == 432134707


def test_low_activity_users(inter):
    counts = inter.groupBy("user_id").count()
    assert counts.where("count < 10").count() == 10
    mm = counts.agg(F.min("count"), F.max("count")).first()
    assert tuple(mm) == (3, 90)


def test_split_halves(inter):
    rep = {(r.part, r.half): (r.n_rows, r.n_users) for r in S.split_report(inter).collect()}
    assert rep[("train", 0)] == (17742, 892)
    assert rep[("train", 1)] == (17614, 891)
    assert rep[("val", 0)] == (5426, 272)
    assert rep[("val", 1)] == (5368, 272)
    assert rep[("test", 0)] == (6625, 336)
    assert rep[("test", 1)] == (6616, 335)


def test_split_tables(inter):
    train, val, _ = S.split_recipe(inter)
    assert train.count() == 47407
    assert (val.count(), val.select("user_id").distinct().count()) == (5368, 272)


def test_exact_half_on_val(inter):
    rows = S.with_split_columns(inter).where("part = 'val'").drop("part", "half")
    out = S.exact_half(rows)
    assert out.count() == 10794
    assert out.where("half = 0").count() == 5468


def test_crosstab(inter):
    t = {r.is_read: r for r in P.crosstab(inter, "is_read", "rating", [0.0, 1.0, 2.0, 3.0]).collect()}
    assert (t[0].r0, t[1].r1, t[1].r2, t[1].r3) == (19573, 8036, 7944, 7986)


def _val_scored(inter):
    _, val, _ = S.split_recipe(inter)
    return val, val.withColumn("prediction", FX.score())


def test_rmse_top5(inter):
    _, sv = _val_scored(inter)
    top = R.top_k(sv, 5, "prediction", method="rank")
    row = M.rmse(top).first()
    assert row.n == 1350
    assert row.rmse == pytest.approx(2.834542532821, abs=1e-9)


def test_map_at_5_relevant(inter):
    val, sv = _val_scored(inter)
    top = R.top_k(sv, 5, "prediction", method="row_number", out="row_num")
    rel = val.where("rating >= 4")
    row = M.mean_average_precision(top, rel).first()
    assert row.n_users == 267
    assert row.map == pytest.approx(0.192812289625, abs=1e-9)


@pytest.mark.parametrize("method", ["row_number", "rank"])
def test_held_out_candidate_map_equals_coverage(inter, method):
    """With held-out pairs as candidates every prediction is relevant: MAP = coverage."""
    val, sv = _val_scored(inter)
    top = R.top_k(sv, 5, "prediction", method=method, out="row_num")
    truth = R.rank_by_value(val, out="true_row")
    got = M.get_map(top.select("user_id", "book_id", "row_num"), truth).first().map
    if method == "row_number":  # exactly 5 positions: the MAP@5 golden
        assert got == pytest.approx(0.314110730607, abs=1e-9)
    cov = M.coverage(top, val).first().coverage
    assert cov == pytest.approx(got, abs=1e-12)


def test_tfidf_totals(spark):
    docs = FX.corpus(spark, SF_CHECK)
    long = T.tfidf_long(docs)
    agg = long.agg(
        F.count("*").alias("rows"),
        F.sum("tf").alias("tokens"),
        F.countDistinct("term").alias("vocab"),
        F.sum(F.round("tfidf", 6)).alias("total"),
    ).first()
    assert (agg.rows, agg.tokens, agg.vocab) == (238931, 322426, 70434)
    assert agg.total == pytest.approx(1275711.096, abs=1e-3)


def test_review_fixture(spark):
    rev = FX.reviews(spark, SF_CHECK)
    assert rev.count() == 2978
    inter = FX.interactions(spark, SF_CHECK).where("is_reviewed = 1")
    n_docs = FX.corpus(spark, SF_CHECK).count()
    doc = hash_bucket("doc", "user_id", "book_id") % n_docs
    # every document can be chosen; nearly all are at this size
    assert inter.select(doc.alias("d")).distinct().count() > 0.9 * n_docs
    assert inter.where("is_read = 0").count() > 0  # reviews of unread books exist
