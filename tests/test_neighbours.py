"""LSH neighbour search over item vectors: recall against brute force, work, ties and hot groups."""

from __future__ import annotations

import numpy as np
import pytest

from quire.operators import neighbours as N


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), [float(v) for v in r] if r is not None else None) for i, r in zip(ids, x)]
    return spark.createDataFrame(rows, "book_id int, factors array<float>").repartition(6)


def brute(x, k):
    u = np.asarray(x, dtype=np.float32).astype(float)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -np.inf)
    return np.argsort(-s, axis=1, kind="stable")[:, :k], s


def lists(df, k):
    out = {}
    for r in df.collect():
        out.setdefault(r.book_id, {})[r["rank"]] = (r.neighbour, r.cosine)
    return {i: [v[j] for j in sorted(v)] for i, v in out.items()}


def test_clustered_vectors_are_found_with_little_work(spark):
    rng = np.random.default_rng(5)
    n, clusters = 12_000, 150
    x = np.abs(rng.normal(size=(clusters, 10)))[rng.integers(0, clusters, n)] + 0.05 * rng.normal(size=(n, 10))
    df = frame(spark, x)
    s = N.search(df, "book_id", "factors")
    got = lists(N.neighbours(df, s, "book_id", "factors"), 10)
    assert len(got) == n and all(len(v) == 10 for v in got.values())
    want, _ = brute(x, 10)
    recall = np.mean([len({j for j, _ in got[i]} & set(want[i].tolist())) / 10 for i in range(0, n, 10)])
    curve = {r.tables: r for r in s.curve().collect()}
    assert recall >= 0.9
    assert curve[s.tables].recall >= 0.95 and curve[s.tables].examined < 0.2
    steps = sorted(curve)
    assert all(curve[a].recall <= curve[b].recall and curve[a].examined < curve[b].examined
               for a, b in zip(steps, steps[1:]))


def test_small_table_equals_brute_force(spark):
    """Fewer vectors than a leaf: everything is compared."""
    x = np.random.default_rng(1).normal(size=(60, 4))
    df = frame(spark, x)
    got = lists(N.neighbours(df, N.search(df, "book_id", "factors"), "book_id", "factors"), 10)
    want, s = brute(x, 10)
    for i in range(60):
        assert [j for j, _ in got[i]] == want[i].tolist()
        assert np.allclose([c for _, c in got[i]], s[i, want[i]], atol=1e-6)


def test_equal_vectors_and_unusable_ones(spark):
    """A third of all vectors are equal; their neighbours are the smallest ids among them."""
    rng = np.random.default_rng(2)
    x = list(rng.normal(size=(200, 5)))
    x += [np.ones(5)] * 100 + [None, np.zeros(5), np.full(5, np.nan)]
    df = frame(spark, x)
    got = lists(N.neighbours(df, N.search(df, "book_id", "factors", N.LshParams(k=4)), "book_id", "factors"), 4)
    assert sorted(got) == list(range(300))
    assert [j for j, _ in got[299]] == [200, 201, 202, 203]
    assert [j for j, _ in got[201]] == [200, 202, 203, 204]


def test_leaf_that_bits_do_not_split(spark):
    """Nearly equal vectors, more than a leaf holds: dealt into parts, each still has its neighbours."""
    rng = np.random.default_rng(3)
    x = np.concatenate((np.ones((400, 6)) + 1e-6 * rng.normal(size=(400, 6)), rng.normal(size=(300, 6))))
    df = frame(spark, x)
    p = N.LshParams(k=5, leaf=64, bits=10, tables=2, max_tables=2, recall=0.0)
    s = N.search(df, "book_id", "factors", p)
    got = lists(N.neighbours(df, s, "book_id", "factors"), 5)
    assert len(got) == 700 and all(len(v) == 5 for v in got.values())
    assert all(c > 0.999999 for i in range(400) for _, c in got[i])
    widest = max(r.work for r in s.found.where("other is null").collect())
    assert widest < 2 * 64


def test_empty(spark):
    df = frame(spark, [])
    s = N.search(df, "book_id", "factors")
    assert N.neighbours(df, s, "book_id", "factors").collect() == []
    one = frame(spark, [np.ones(3)])
    assert N.neighbours(one, N.search(one, "book_id", "factors"), "book_id", "factors").collect() == []


@pytest.mark.parametrize("n", [5])
def test_fewer_than_k(spark, n):
    x = np.random.default_rng(4).normal(size=(n, 3))
    df = frame(spark, x)
    got = lists(N.neighbours(df, N.search(df, "book_id", "factors"), "book_id", "factors"), 10)
    assert all(len(v) == n - 1 for v in got.values()) and len(got) == n


def test_leaves_are_not_broadcast(spark):
    """A row per level and string: the estimate of a small file says nothing about it."""
    rows = [(i, i % 4, i * 7919) for i in range(400)]
    from quire.session import written

    codes = written(spark.createDataFrame(rows, "rep long, tab int, code long"), "test-codes")
    leaves = N._leaves(codes, N.LshParams(leaf=16), 100)
    plan = leaves._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert leaves.count() == 400


def test_leaves_of_dense_regions_are_found_below_the_near_levels(spark):
    """Against a count of every prefix: spread strings, a region that differs in its last bits only, equal strings."""
    p = N.LshParams(leaf=4, bits=20)
    codes = [(i * 104729) % (1 << 20) for i in range(200)] + [(1 << 19) + i for i in range(40)] + [77] * 9
    df = spark.createDataFrame([(i, 0, c) for i, c in enumerate(codes)], "rep long, tab int, code long")
    got = {r.code: (r.level, r.parts) for r in N._leaves(df, p, len(codes)).collect()}
    start = max(0, int(np.log2(len(codes) / p.leaf)) - 3)
    want = {}
    for c in set(codes):
        for level in range(start, p.bits + 1):
            m = sum(x >> (p.bits - level) == c >> (p.bits - level) for x in codes)
            if m <= p.leaf or level == p.bits:
                want[c] = (level, -(-m // p.leaf))
                break
    assert got == want and max(v[0] for v in want.values()) > start + N.NEAR_LEVELS


def test_vectors_travel_once_per_table(spark):
    """Cells find their leaves themselves: no strings are counted at every level and joined with vectors."""
    rng = np.random.default_rng(7)
    df = frame(spark, rng.normal(size=(3000, 5)))
    p = N.LshParams(k=4, leaf=32, bits=20, tables=2)
    points = N.written(N.entries(N.unit_vectors(df, "book_id", "factors"), p.k), "test-points")
    found = N.table_pairs(points, p, 0, 2, N._mean(points), 3000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    s = N.Search(points, N.written(found, "test-found"), None, p, 2, 3000)
    curve = N.recall_curve(s.found, N.exact_neighbours(points, points.where("rep < 40"), 4), [1, 2], 3000)
    lines = curve._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in lines
    near = N.neighbours(df, s, "book_id", "factors")
    assert sorted({r.book_id for r in near.collect()}) == list(range(3000))


@pytest.mark.parametrize("leaves", [1, 64])
def test_cells_and_counts_give_the_same_pairs(spark, monkeypatch, leaves):
    """Crowded cells (here: all of them) are cut by counts; spread vectors, a dense region, vectors no bit splits."""
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(size=(900, 4)), np.ones((300, 4)) + 1e-7 * rng.normal(size=(300, 4))))
    df = frame(spark, x)
    p = N.LshParams(k=4, leaf=16, bits=12)
    points = N.written(N.entries(N.unit_vectors(df, "book_id", "factors"), p.k), "test-points")
    n, mean = points.count(), N._mean(points)
    codes = N.written(points.select("rep", "unit").mapInArrow(N._codes(p, 0, 2, mean), "rep long, tab int, code long"), "test-codes")
    rows = lambda f: sorted((r.id, r.tab, r.other or -1, r.work) for r in f.collect())
    monkeypatch.setattr(N, "CELL_LEAVES", leaves)
    assert rows(N.table_pairs(points, p, 0, 2, mean, n)) == rows(N._crowded_pairs(points, codes, p, n))
