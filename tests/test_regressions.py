"""Regressions: their rows are kept once, several points run at a time, read rows are known by their flag."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quire.functions.columns import typed_interactions
from quire.operators import models as MD
from quire.plans import tune as TU
from quire.registry import models, tuning
from quire.registry.common import parts
from quire.registry.text import review_features
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def feats(spark):
    rows = [(i % 4, i, float(i % 5), Vectors.sparse(30, [i % 30], [1.0])) for i in range(60)]
    return spark.createDataFrame(rows, ["user_id", "book_id", "rating", "idf_features"])


def test_the_estimator_alone_keeps_the_rows(spark, feats, monkeypatch):
    """No second copy beside the estimator's packed rows, in memory or on disk."""
    kept, real = [], MD.LinearRegression.fit

    def noted(self, d):
        level = d.storageLevel
        kept.append((level.useMemory or level.useDisk, spark.sparkContext._jsc.getPersistentRDDs().size()))
        return real(self, d)

    monkeypatch.setattr(MD.LinearRegression, "fit", noted)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    MD.fit_lr(feats, 0.1, 0.01)
    tuning._lr_results(spark, feats, feats, [0.1], [0.01], max_iter=3)
    assert kept == [(False, before)] * 2


def test_points_of_the_grid_run_at_a_time(spark, feats, monkeypatch):
    running, most, lock, real = [0], [0], threading.Lock(), MD.fit_lr

    def slow(*a, **k):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(2.0)
        with lock:
            running[0] -= 1
        return real(*a, **k)

    monkeypatch.setattr(MD, "fit_lr", slow)
    fitted: dict = {}
    out = TU.lr_grid(spark, feats, feats, [0.1, 0.2], [0.01], "t", k=5, max_iter=3, models=fitted)
    assert most[0] == 2 and out.count() == 2 and set(fitted) == {(0.1, 0.01), (0.2, 0.01)}
    most[0] = 0
    TU.lr_grid(spark, feats, feats, [0.1, 0.2], [0.01], "t", k=5, max_iter=3, parallelism=1)
    assert most[0] == 1


def test_as_many_fits_as_the_driver_holds(spark, feats):
    assert MD.fits_at_once(feats, 1) == 1 and MD.fits_at_once(feats, 35) == 35 and MD.fits_at_once(feats.limit(0), 2) == 1
    wide = spark.createDataFrame([(Vectors.sparse(2_000_000_000, [1], [1.0]),)], ["idf_features"])
    assert MD.fits_at_once(wide, 35) == 1


def test_read_features_are_those_of_read_rows(spark):
    keys = ["user_id", "book_id", "rating"]
    for rows, f in zip(parts(spark, SF_SMALL), review_features(spark, SF_SMALL), strict=True):
        got = models.read_features(f)
        want = f.drop("is_read").join(typed_interactions(rows).where("is_read <> 0").select(*keys), keys)
        assert sorted(map(str, got.select(*keys).collect())) == sorted(map(str, want.select(*keys).collect()))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and got.where(F.col("idf_features").isNull()).count() == 0
