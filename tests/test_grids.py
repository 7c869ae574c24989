"""Resumable, concurrent grids and the keyed results sink."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import models as MD
from quire.plans import tune as TU
from quire.registry import tuning
from quire.session import scratch_path
from quire.sources.schemas import RESULTS
from tests.conftest import SF_SMALL

GRID = TU.als_grid([1, 2], [2, 3], [0.1])
KEYS = TU.RESULT_KEYS


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(u, b, float((u + b) % 5 + 1)) for u in range(6) for b in range(5)]
    return spark.createDataFrame(rows, "user_id int, book_id int, rating double").cache()


def scores(pairs, p):
    return pairs.withColumn("prediction", F.col("rating") + F.lit(p.reg * p.rank + p.max_iter / 10))


def row(variant, reg, rmse):
    return (variant, "100", 5, 10, reg, rmse, 0.5, 0.5, 3, 2)


def test_a_repeated_append_leaves_one_row_per_key(spark):
    path = scratch_path(spark, "results-test")
    assert TU.read_results(spark, path, RESULTS).count() == 0
    first = spark.createDataFrame([row("a", 0.1, 1.0), row("a", 0.2, 2.0), row("b", 0.1, 3.0)], RESULTS)
    for _ in range(2):
        TU.commit_results(first, path, KEYS)
    TU.commit_results(spark.createDataFrame([row("a", 0.2, 9.0), row("c", None, 4.0)], RESULTS), path, KEYS)
    got = sorted((r.variant, r.reg, r.rmse) for r in TU.read_results(spark, path, RESULTS).collect() if r.reg)
    assert got == [("a", 0.1, 1.0), ("a", 0.2, 9.0), ("b", 0.1, 3.0)]
    back = TU.read_results(spark, path, RESULTS)
    assert back.count() == 4 and back.schema == RESULTS


def test_rows_of_one_append_that_share_a_key_count_once(spark):
    path = scratch_path(spark, "results-test")
    TU.commit_results(spark.createDataFrame([row("a", 0.1, 1.0)] * 5, RESULTS).repartition(5), path, KEYS)
    assert TU.read_results(spark, path, RESULTS).count() == 1


def test_appends_at_the_same_time(spark):
    path = scratch_path(spark, "results-test")
    frames = [spark.createDataFrame([row(f"v{i}", 0.1, float(i))], RESULTS) for i in range(8)]
    threads = [threading.Thread(target=TU.commit_results, args=(f, path, KEYS)) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.rmse for r in TU.read_results(spark, path, RESULTS).collect()) == [float(i) for i in range(8)]


@pytest.mark.parametrize("parallelism", [1, 3])
def test_a_stopped_grid_goes_on_without_fitting_twice(spark, pairs, parallelism):
    sink, fitted, lock = scratch_path(spark, "ledger-test"), [], threading.Lock()

    def scorer(p):
        with lock:
            fitted.append((p.max_iter, p.rank))
            if len(fitted) == 3 and not resumed:
                raise RuntimeError("killed")
        return scores(pairs, p)

    resumed = False
    with pytest.raises(RuntimeError):
        TU.grid_search(spark, GRID, scorer, pairs, "v", "1", sink=sink, parallelism=parallelism)
    done = {(r.max_iter, r["rank"]) for r in TU.read_results(spark, sink, RESULTS).collect()}
    assert 0 < len(done) < len(GRID)
    resumed, before = True, list(fitted)
    out = TU.grid_search(spark, GRID, scorer, pairs, "v", "1", sink=sink, parallelism=parallelism)
    again = fitted[len(before):]
    assert len(again) == len(set(again)) and not set(again) & done
    assert {(r.max_iter, r["rank"]) for r in out.collect()} == {(p.max_iter, p.rank) for p in GRID}
    fitted.clear()
    TU.grid_search(spark, GRID, scorer, pairs, "v", "1", sink=sink)
    assert fitted == []
    TU.grid_search(spark, GRID[:1], scorer, pairs, "v", "25", sink=sink)  # another sample of the same sink
    assert len(fitted) == 1


def test_several_fits_at_once_in_pools(spark, pairs):
    running, most, pools, lock = [0], [0], set(), threading.Lock()

    def scorer(p):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
            pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        time.sleep(1.0)
        with lock:
            running[0] -= 1
        return scores(pairs, p)

    out = TU.grid_search(spark, GRID, scorer, pairs, "v", "1", parallelism=2)
    alone = TU.grid_search(spark, GRID, lambda p: scores(pairs, p), pairs, "v", "1")
    assert most[0] == 2 and pools == {"grid-0", "grid-1"}
    assert sorted(out.collect()) == sorted(alone.collect())


def test_registered_grid_takes_grid_ledger_and_parallelism(spark):
    sink = scratch_path(spark, "ledger-test")
    grid = TU.als_grid([1], [2, 3, 4], [0.1])
    out = tuning.grid_als(spark, SF_SMALL, grid, sink=sink, parallelism=3)
    assert sorted(r["rank"] for r in out.collect()) == [2, 3, 4]
    assert TU.read_results(spark, sink, RESULTS).count() == 3


def test_full_grids_have_their_points():
    regs, nets = tuning.FULL_LR_GRID
    assert (len(tuning.FULL_GRID), len(tuning.FULL_REVIEW_GRID), len(regs) * len(nets)) == (63, 10, 35)
    assert all(isinstance(p, MD.ALSParams) for p in tuning.FULL_GRID)


def test_a_winner_is_not_fitted_again(spark, monkeypatch):
    """Validation and test share the models: two points and one unread model are three fits."""
    real, fits = MD.fit_als, []
    monkeypatch.setattr(MD, "fit_als", lambda train, p=MD.ALSParams(), **c: fits.append(p) or real(train, p, **c))
    assert tuning.final_eval_read(spark, SF_SMALL).count() == 1
    assert len(fits) == 3
    fits.clear()
    assert tuning.final_eval(spark, SF_SMALL).count() == 1
    assert len(fits) == 2


@pytest.mark.parametrize("name", ["grid_als", "grid_als_read"])
def test_a_grid_keeps_no_copy_of_its_tables(spark, monkeypatch, name):
    """ALS keeps its own blocks of the staged rows; the grid does not hold the rows beside them."""
    real, held = MD.fit_als, []

    def noted(train, p=MD.ALSParams(), **c):
        held.append((train.storageLevel.useMemory, spark.sparkContext._jsc.getPersistentRDDs().size()))
        return real(train, p, **c)

    monkeypatch.setattr(MD, "fit_als", noted)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert tuning.QUERIES[name](spark, SF_SMALL, TU.als_grid([1], [2], [0.1])).count() == 1
    assert held[0] == (False, before)
