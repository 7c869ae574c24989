"""Cold-start mapping: normal equations, mapped factors and the evaluation against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import coldstart as C
from quire.operators import factors as FA
from quire.operators import models as MD


def items_table(spark, n=60, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", None]), f"word{rng.randrange(4)} tail", rng.random() * 10) for k in range(n)]
    return spark.createDataFrame(rows, "book_id int, kind string, title string, size double").repartition(4)


def features(spark, **kw):
    return C.item_features(items_table(spark), categories=("kind",), words=("title",), numbers=("size",), **kw)


def test_features_are_counts_and_standardised_numbers(spark):
    rows = {r.book_id: r.x for r in features(spark, buckets=16).collect()}
    assert len(rows) == 60 and all(len(x) == 2 + 16 and x[0] == 1.0 for x in rows.values())
    size = np.array([x[1] for x in rows.values()])
    assert abs(size.mean()) < 1e-9 and abs(size.std() - 1) < 1e-9
    kinds = {r.book_id: r.kind for r in items_table(spark).collect()}
    assert all(sum(x[2:]) == (2 if kinds[i] is None else 3) for i, x in rows.items())


def test_map_equals_least_squares(spark):
    x = features(spark, buckets=8)
    rng = np.random.default_rng(3)
    y = {k: rng.normal(size=4).astype(np.float32) for k in range(0, 60, 2)}  # every other item is warm
    factors = spark.createDataFrame([(k, v.tolist()) for k, v in y.items()], "book_id int, factors array<float>")
    fitted = C.fit_map(factors, x, ridge=0.5)
    table = {r.book_id: np.array(r.x) for r in x.collect()}
    a = np.array([table[k] for k in y])
    b = np.array([y[k] for k in y], dtype=float)
    penalty = 0.5 * np.eye(a.shape[1])
    penalty[0, 0] = 0
    want = np.linalg.lstsq(a.T @ a + penalty, a.T @ b, rcond=None)[0]
    assert fitted.n_items == len(y)
    assert np.allclose(a @ fitted.weights.T, a @ want, atol=1e-8)
    got = {r.book_id: r.factors for r in C.map_factors(x, fitted).collect()}
    assert len(got) == 60 and all(np.allclose(got[k], table[k] @ want, atol=1e-8) for k in got)


def test_no_item_in_common(spark):
    factors = spark.createDataFrame([(1000, [1.0])], "book_id int, factors array<float>")
    with pytest.raises(ValueError):
        C.fit_map(factors, features(spark))


@pytest.fixture(scope="module")
def structured(spark):
    """Ratings that follow from features of the item: a cold item is predictable."""
    rng = np.random.default_rng(7)
    n_users, n_items = 120, 90
    size = rng.random(n_items)
    taste = rng.random(n_users)
    rows = [
        (u, i, float(1 + 4 * taste[u] * size[i]))
        for u in range(n_users) for i in range(n_items) if rng.random() < 0.5
    ]
    inter = spark.createDataFrame(rows, "user_id int, book_id int, rating double")
    items = spark.createDataFrame([(i, float(size[i])) for i in range(n_items)], "book_id int, size double")
    held = F.pmod(F.xxhash64("user_id", "book_id"), F.lit(5)) == 0
    return inter.where(~held), inter.where(held), C.item_features(items, numbers=("size",), buckets=1)


def test_report_equals_brute_force(spark, structured):
    train, heldout, x = structured
    cold = F.col("book_id") % 10 == 0
    params = MD.ALSParams(max_iter=8, rank=3, reg=0.01)
    scores = C.cold_start_scores(train, heldout, x, cold, params).cache()
    rows = {r.method: r for r in C.cold_start_report(scores).collect()}
    assert set(rows) == {"mapped", "full", "mean"}
    # pairs: by sets
    tr, ho = [(r[0], r[1]) for r in train.collect()], [(r[0], r[1], r[2]) for r in heldout.collect()]
    warm_users, items = {u for u, i in tr if i % 10}, {i for _, i in tr}
    want = {(u, i) for u, i, _ in ho if i % 10 == 0 and u in warm_users and i in items}
    assert {(r.user_id, r.book_id) for r in scores.collect()} == want
    # predictions: by numpy from the models' factors
    partial, full = MD.fit_als(train.where(~cold), params), MD.fit_als(train, params)
    table = lambda df, k: {r[k]: np.array(r.factors, dtype=float) for r in df.collect()}
    pu, pi = table(FA.user_factors(partial), "user_id"), table(FA.item_factors(partial), "book_id")
    fu, fi = table(FA.user_factors(full), "user_id"), table(FA.item_factors(full), "book_id")
    xs = {r.book_id: np.array(r.x) for r in x.collect()}
    a, b = np.array([xs[i] for i in pi]), np.array(list(pi.values()))
    w = np.linalg.lstsq(a.T @ a + np.diag([0.0, *[1.0] * (a.shape[1] - 1)]), a.T @ b, rcond=None)[0]
    mean = b.mean(axis=0)
    rating = {(u, i): r for u, i, r in ho}
    square = {"mapped": [], "full": [], "mean": []}
    for u, i in want:
        for m, p in (("mapped", pu[u] @ (xs[i] @ w)), ("full", fu[u] @ fi[i]), ("mean", pu[u] @ mean)):
            square[m].append((p - rating[u, i]) ** 2)
    for m, r in rows.items():
        assert r.n_pairs == len(want) and r.n_items == len({i for _, i in want})
        assert r.rmse == pytest.approx(np.sqrt(np.mean(square[m])), abs=1e-4)
    # features carry the signal: nearly as good as having seen the item, far better than the mean
    assert rows["mapped"].rmse < 0.5 * rows["mean"].rmse and rows["mapped"].rmse < 3 * rows["full"].rmse


def test_features_are_not_broadcast(spark, monkeypatch):
    """Arrays count as one value in a plan's estimate; the design matrix is joined by shuffles."""
    from quire.session import written

    ids = spark.range(80).select(F.col("id").cast("int").alias("book_id"))
    x = F.array(F.lit(1.0), F.col("book_id").cast("double"), (F.col("book_id") % 7).cast("double"))
    features = written(ids.select("book_id", x.alias("x")), "test-features")
    factors = written(ids.select("book_id", F.array(F.col("book_id") * 0.5, F.lit(2.0)).alias("factors")), "test-factors")
    plans, real = [], C.normal_equations

    def seen(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return real(rows)

    monkeypatch.setattr(C, "normal_equations", seen)
    assert C.fit_map(factors, features).n_items == 80
    assert "Broadcast" not in plans[0] and "SortMergeJoin" in plans[0]
