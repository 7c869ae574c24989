"""All-items top-k with seen pairs left out: equal to brute force; bounded work for long histories."""

from __future__ import annotations

import numpy as np
import pytest

from quire.operators import recommend as R

SMALL = R.RecommendParams(block_users=7, wave_items=40, tile_items=8, rows=3)


def frames(spark, u, v):
    users = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in u.items()], "user_id int, factors array<float>")
    items = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in v.items()], "book_id int, factors array<float>")
    return users.repartition(3), items.repartition(4)


def brute(u, v, k, seen):
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids], dtype=np.float32).astype(float)
    out = {}
    for i, x in u.items():
        s = m @ np.asarray(x, dtype=np.float32).astype(float)
        best = sorted((-s[j], int(ids[j])) for j in range(len(ids)) if (i, int(ids[j])) not in seen)[:k]
        out[i] = [(b, -a) for a, b in best]
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.user_id, {})[r.pos] = (r.book_id, r.prediction)
    return {i: [v[j] for j in sorted(v)] for i, v in out.items()}


def data(seed=1, n_users=23, n_items=130, dim=5):
    rng = np.random.default_rng(seed)
    u = {3 * i + 1: np.abs(rng.normal(size=dim)) for i in range(n_users)}
    v = {2 * i: np.abs(rng.normal(size=dim)) * rng.lognormal(0, 1) for i in range(n_items)}
    return u, v


@pytest.mark.parametrize("p", [R.DEFAULT, SMALL])
@pytest.mark.parametrize("k", [1, 10, 500])
def test_equals_brute_force(spark, p, k):
    u, v = data()
    rng = np.random.default_rng(2)
    seen = {(i, j) for i in u for j in v if rng.random() < 0.1}
    seen |= {(1, j) for j in sorted(v)[: len(v) // 2]}  # half the catalogue
    seen |= {(4, j) for j in v} | {(999, 0), (7, 999)}  # everything; unknown user and item
    pairs = spark.createDataFrame(sorted(seen) * 2, "user_id int, book_id int")
    users, items = frames(spark, u, v)
    a, b = got(R.top_items(users, items, k, seen=pairs, p=p)), brute(u, v, k, seen)
    assert set(a) == {i for i in b if b[i]}
    for i in a:
        assert [x for x, _ in a[i]] == [x for x, _ in b[i]]
        assert np.allclose([s for _, s in a[i]], [s for _, s in b[i]])


def test_ties_go_to_the_smaller_item(spark):
    u = {1: np.ones(3), 2: np.zeros(3)}
    v = {i: np.ones(3) for i in range(90)} | {100 + i: np.zeros(3) for i in range(30)}
    users, items = frames(spark, u, v)
    a = got(R.top_items(users, items, 5, p=SMALL))
    assert [x for x, _ in a[1]] == [0, 1, 2, 3, 4] and [x for x, _ in a[2]] == [0, 1, 2, 3, 4]


def test_a_long_history_does_not_lengthen_other_lists(spark):
    """Work and lists of the other users are the same whether or not one user has seen half the catalogue."""
    u, v = data(n_items=400)
    users, items = frames(spark, u, v)
    few = spark.createDataFrame([(4, 0)], "user_id int, book_id int")
    many = spark.createDataFrame([(1, j) for j in sorted(v)[:200]] + [(4, 0)], "user_id int, book_id int")
    a, b = (got(R.top_items(users, items, 10, seen=s, p=SMALL)) for s in (few, many))
    assert all(a[i] == b[i] for i in u if i != 1) and all(len(x) == 10 for x in b.values())
    work = [sum(r.compared for r in R.search(users, items, 10, seen=s, p=SMALL).collect()) for s in (few, many)]
    assert work[1] < 1.3 * work[0]


def test_small_norms_are_skipped(spark):
    """Items whose norm cannot reach the heaps are not compared, and the lists stay exact."""
    rng = np.random.default_rng(4)
    u = {i: np.abs(rng.normal(size=4)) + 0.5 for i in range(30)}
    v = {i: (np.abs(rng.normal(size=4)) + 0.5) * (10 if i < 50 else 0.01) for i in range(2000)}
    users, items = frames(spark, u, v)
    blocks = R.search(users, items, 5, p=R.RecommendParams(block_users=10, wave_items=200, tile_items=50))
    assert sum(r.compared for r in blocks.collect()) < 0.1 * 30 * 2000
    a = got(R.top_items(users, items, 5, p=SMALL))
    b = brute(u, v, 5, set())
    assert all([x for x, _ in a[i]] == [x for x, _ in b[i]] for i in u)


def test_empty_sides(spark):
    u, v = data(n_users=2, n_items=3)
    users, items = frames(spark, u, v)
    assert R.top_items(users.limit(0), items, 3).collect() == []
    assert R.top_items(users, items.limit(0), 3).collect() == []


def test_heaps_are_written_once(spark, monkeypatch):
    """However many waves the items make: no heap goes to the shared folder before it is finished."""
    u, v = data(n_items=400)
    users, items = frames(spark, u, v)
    names = []

    def noted(df, name):
        names.append(name)
        return written(df, name)

    written = R.written
    monkeypatch.setattr(R, "written", noted)
    for wave in (40, 400):  # ten waves, one wave
        names.clear()
        p = R.RecommendParams(block_users=7, wave_items=wave, tile_items=8, rows=3)
        assert all(len(x) == 10 for x in got(R.top_items(users, items, 10, p=p)).values())
        assert len(names) <= 4 and len(set(names)) == len(names)


def test_lanes_hold_a_bounded_number_of_users():
    assert R.lanes_for(1, 8) == 1 and R.lanes_for(10_000, 8) == 8 and R.lanes_for(10**6, 12) % 12 == 0
    assert all(n / R.lanes_for(n, 12) <= R.DEFAULT.lane_users for n in (10**5, 10**6, 10**8))


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e20])
def test_scores_closer_than_single_precision_are_told_apart(spark, scale):
    """Items that differ in their last bits: the list is that of the exact products."""
    rng = np.random.default_rng(5)
    u = {i: (np.abs(rng.normal(size=6)) + 0.1) * scale for i in range(5)}
    near = np.float32(1) + np.float32(2**-23) * rng.integers(0, 9, size=(300, 6)).astype(np.float32)
    v = {i: x * np.float32(scale) if scale > 1e-10 else x for i, x in enumerate(near)}
    users, items = frames(spark, u, v)
    a, b = got(R.top_items(users, items, 20, p=SMALL)), brute(u, v, 20, set())
    for i in u:
        assert [s for _, s in a[i]] == pytest.approx([s for _, s in b[i]], rel=1e-14)


def test_lanes_hold_few_rows_of_what_passes_by(spark, monkeypatch):
    """A lane takes some waves at a time, a heap is a row by itself, and the session's setting comes back."""
    u, v = data(n_items=400)
    users, items = frames(spark, u, v)
    before, seen, written, lane = spark.conf.get(R.ARROW_ROWS), {}, R.written, R._lane

    def noted(df, name):
        seen[name] = spark.conf.get(R.ARROW_ROWS)
        return written(df, name)

    def watched(k, p):
        run = lane(k, p)

        def some(batches):
            def few():
                for b in batches:
                    assert b.num_rows <= 8, b.num_rows
                    yield b

            yield from run(few())

        return some

    monkeypatch.setattr(R, "written", noted)
    monkeypatch.setattr(R, "_lane", watched)
    rows = R.search(users, items, 5, p=R.RecommendParams(block_users=7, wave_items=10, tile_items=8, rows=3)).collect()
    assert seen["user-heaps"] == str(R.FEED_ROWS) and spark.conf.get(R.ARROW_ROWS) == before
    assert len(rows) == len(u) and {len(r.users) for r in rows} == {8} and {len(r["items"]) for r in rows} == {5 * 8}
