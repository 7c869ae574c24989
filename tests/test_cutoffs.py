"""All cutoffs from one ranked table: equal to brute force, with ties, duplicates and hot users; plan size."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from quire.plans import evaluate as EV
from quire.registry import all_queries
from tests.conftest import SF_SMALL

SCHEMA = "cfg string, user_id int, book_id int, rating double, prediction double"


def brute(preds, held, ks, least):
    pairs = {(u, b): r for u, b, r in held}
    users = {u for u, _ in pairs}
    n_held = {u: sum(x == u for x, _ in pairs) for u in users}
    truth = {u: {b for (x, b), r in pairs.items() if x == u and r >= least} for u in users}
    out = {}
    for cfg in {p[0] for p in preds}:
        best = {}
        for c, u, b, r, s in preds:
            if c == cfg and ((u, b) not in best or (s, r) > best[u, b]):
                best[u, b] = (s, r)
        for k in ks:
            se, n, aps, cov = 0.0, 0, [], 0.0
            for u in {u for u, _ in best}:
                rows = sorted((-s, b, r) for (x, b), (s, r) in best.items() if x == u)
                ranks = [1 + sum(y[0] < x[0] for y in rows) for x in rows]
                top = [x for x, rk in zip(rows, ranks) if rk <= k]
                se += sum((-s - r) ** 2 for s, _, r in top)
                n += len(top)
                if u in n_held:
                    cov += len(top) / n_held[u]
                if truth.get(u):
                    hits, ap = 0, 0.0
                    for pos, (_, b, _) in enumerate(top, 1):
                        if b in truth[u]:
                            hits += 1
                            ap += hits / pos
                    aps.append(ap / len(truth[u]))
            out[cfg, k] = (math.sqrt(se / n), n, sum(aps) / len(aps) if aps else None, len(aps), cov / len(users), len(users))
    return out


def run(spark, preds, held, ks, least):
    p = spark.createDataFrame(preds, SCHEMA).repartition(4)
    h = spark.createDataFrame(held, "user_id int, book_id int, rating double")
    rows = EV.evaluate_cutoffs(p, h, ks, relevant_min=least, config_cols=("cfg",)).collect()
    return {(r.cfg, r.k): (r.rmse, r.n_rows, r.map, r.n_map_users, r.coverage, r.n_users) for r in rows}


@pytest.mark.parametrize("bits", [2, 10])
def test_equals_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(EV, "RANGE_BITS", bits)
    rng = random.Random(bits)
    held = [(u, b, float(rng.randrange(1, 6))) for u in range(12) for b in rng.sample(range(100), 20)]
    preds = []
    for cfg in ("a", "b"):
        for u in range(1, 14):  # user 0 has no prediction, 12 and 13 no truth
            for b in rng.sample(range(100), 30):
                preds.append((cfg, u, b, float(rng.randrange(1, 6)), rng.choice([0.0, 1.0, 1.5, rng.random() * 5])))
    preds += preds[::7]  # repeated rows
    preds += [(c, u, b, r, s - 1) for c, u, b, r, s in preds[::11]]  # a pair with two scores
    got, want = run(spark, preds, held, (1, 3, 10, 500), 4), brute(preds, held, (1, 3, 10, 500), 4)
    assert set(got) == set(want)
    for key, w in want.items():
        assert got[key] == pytest.approx(w), key


def test_one_large_tie(spark):
    """A user whose scores are all equal, over several ranges of items."""
    held = [(1, b, 5.0) for b in range(0, 9000, 3)] + [(2, 1, 5.0)]
    preds = [("a", 1, b, 1.0, 2.0) for b in range(9000)] + [("a", 2, 1, 1.0, 1.0), ("a", 2, 2, 1.0, 2.0)]
    got = run(spark, preds, held, (1, 5), 4)
    hits = [i for i, b in enumerate(range(9000), 1) if b % 3 == 0]
    ap = sum(j / i for j, i in enumerate(hits, 1)) / len(hits)
    assert got["a", 1] == pytest.approx((math.sqrt((9000 + 1) / 9001), 9001, ap / 2, 2, (3 + 1) / 2, 2))
    assert got["a", 5] == pytest.approx((math.sqrt((9000 + 1) / 9002), 9002, (ap + 0.5) / 2, 2, (3 + 2) / 2, 2))


def test_plan_is_small(spark):
    """One scan side and one ranked table for all cutoffs and configurations."""
    plan = all_queries()["eval_grid"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.rfind("Initial Plan"):] if "Initial Plan" in plan else plan
    assert initial.count("Exchange ") <= 12
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_no_truth_and_no_predictions(spark):
    held = [(1, 1, 1.0)]
    assert run(spark, [("a", 1, 1, 1.0, 2.0)], held, (3,), 4)["a", 3][2:4] == (None, 0)
    empty = spark.createDataFrame([], SCHEMA)
    h = spark.createDataFrame(held, "user_id int, book_id int, rating double")
    assert EV.evaluate_cutoffs(empty, h, (3,), config_cols=("cfg",)).collect() == []
    one = EV.evaluate_topk(empty.drop("cfg"), h, 3).first()
    assert one is None or one.n_users == 1


def test_ranking_curve_equals_one_cutoff_at_a_time(spark):
    from quire.operators import metrics as M

    rng = random.Random(9)
    pred = [(u, b, p) for u in range(15) for p, b in enumerate(rng.sample(range(60), rng.randrange(1, 20)), 1)]
    pred += [(1, 7, 3)] * 2  # an item listed again
    truth = [(u, b) for u in range(3, 18) for b in rng.sample(range(60), rng.randrange(1, 15))]
    p = spark.createDataFrame(pred, "user_id int, book_id int, row_num int")
    t = spark.createDataFrame(truth + truth[:5], "user_id int, book_id int")
    names = ("map_at_k", "precision_at_k", "recall_at_k", "ndcg_at_k", "n_users")
    curve = {r.k: [r[c] for c in names] for r in M.ranking_curve(p, t, (1, 2, 5, 40)).collect()}
    for k in (1, 2, 5, 40):
        one = M.ranking_metrics(p, t, k).first()
        assert curve[k] == pytest.approx([one[c] for c in names])
