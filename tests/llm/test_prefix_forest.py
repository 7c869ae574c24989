import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from quire.llm import prefix_forest as f

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("rep", T.StringType()),
        T.StructField("tree", T.StringType()),
    ]
)


def vectors(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(rows, every, top):
    seen = {(i, tuple(v)) for i, v in rows}
    out = {}
    for q, qv in seen:
        if q % every == 0:
            scored = {}
            for i, v in seen:
                if i != q:
                    s = float(np.dot(np.float32(qv).astype(float), np.float32(v).astype(float)))
                    scored[i] = max(s, scored.get(i, -np.inf))
            out[q] = sorted(((-s, i) for i, s in scored.items()))[:top]
    return out


def test_recall_and_order(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((1500, 24)).tolist())]
    p = f.ForestParams(block=300)
    got = f.search(vectors(spark, rows), 50, p).collect()
    want = brute(rows, 50, 20)
    hits = 0
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & {i for _, i in near})
    assert hits / (20 * len(want)) >= 0.9


def test_share_falls_as_clusters_become_more(spark):
    """Clusters of a fixed size: the share of candidates follows the table, the recall stays."""
    rng = np.random.default_rng(6)
    shares = []
    for clusters in (10, 160):
        centres = rng.standard_normal((clusters, 32))
        x = np.repeat(centres, 60, axis=0) + 0.05 * rng.standard_normal((60 * clusters, 32))
        df = vectors(spark, list(enumerate(x.tolist())))
        entries = f.distinct_vectors(f.valid_vectors(df), f.PARAMS.top + 1).cache()
        longest = float(np.linalg.norm(np.float32(x).astype(float), axis=1).max())
        shares.append(f.fit_share(entries, len(x), longest, f.PARAMS))
    assert shares[1] < 0.3 * shares[0]
    got = f.search(df, 400).collect()
    want = brute(list(enumerate(x.tolist())), 400, 20)
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {i for _, i in near}) for q, near in want.items())
    assert hits / (20 * len(want)) >= 0.9


def test_a_few_long_vectors_do_not_spoil_the_others(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((60, 24))
    x = np.repeat(centres, 40, axis=0) + 0.05 * rng.standard_normal((2400, 24))
    shares = []
    for factor in (1.0, 5.0):
        y = x.copy()
        y[:2] *= factor
        df = vectors(spark, list(enumerate(y.tolist())))
        entries = f.distinct_vectors(f.valid_vectors(df), f.PARAMS.top + 1).cache()
        longest = float(np.linalg.norm(np.float32(y).astype(float), axis=1).max())
        shares.append(f.fit_share(entries, len(x), longest, f.PARAMS))
    assert shares[1] < 2 * shares[0] and shares[0] < 1


def test_double_vectors_are_scored_as_they_are(spark):
    rng = np.random.default_rng(7)
    x = 1 + 1e-9 * rng.standard_normal((30, 4))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in f.search(df, 20).collect()}
    for q in (0, 20):
        for i in range(30):
            if i != q and (q, i) in got:
                assert abs(got[q, i] - float(x[q] @ x[i])) < 1e-14
        order = sorted((-float(x[q] @ x[i]), i) for i in range(30) if i != q)[:20]
        assert {i for _, i in order} == {i for k, i in got if k == q}


def test_hot_vector_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(8).tolist()
    rows = [(i, hot) for i in range(0, 200, 2)] + [(i, rng.standard_normal(8).tolist()) for i in range(1, 60, 2)]
    rows += [(0, hot)]
    bad = [(300, None), (320, [0.0] * 8), (340, [None] * 8), (360, [float("nan")] * 8), (380, [float("inf")] * 8)]
    bad += [(400, [1.0, 2.0]), (None, hot)]
    got = f.search(vectors(spark, rows + bad), 20, f.ForestParams(block=16)).collect()
    assert all(r.query_id < 300 and r.vec_id < 300 for r in got)
    for q, near in brute(rows, 20, 20).items():
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert len(mine) == 20 and q not in mine
        assert mine == [i for _, i in near]  # the copies of the hot vector, by id


def test_few_and_none(spark):
    few = f.search(vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]), 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(few, key=lambda r: r["rank"])] == [
        (0, 1, 1, 0.5),
        (0, 2, 2, 0.0),
    ]
    assert f.search(vectors(spark, []), 20).collect() == []


@pytest.mark.parametrize("norms", [1.0, 5.0])
def test_strings_share_prefixes_with_direction(norms):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2, 16)).astype(np.float32)
    near = np.concatenate((x[:1], x[:1] * 0.999 + 0.001 * x[1:], -x[:1])) * np.float32(norms)
    s = f.hash_strings(near, float(np.linalg.norm(near, axis=1).max()), f.PARAMS, True)
    common = lambda a, b: f.PARAMS.bits - int(a ^ b).bit_length()
    assert np.mean([common(a, b) for a, b in zip(s[0], s[1], strict=True)]) > 20
    assert np.mean([common(a, b) for a, b in zip(s[0], s[2], strict=True)]) < 1


def test_ties_of_distinct_vectors_go_to_the_smallest_ids():
    """Three hundred different vectors have the same product with the query."""
    n, keep = 300, 21
    rng = np.random.default_rng(4)
    rep = rng.permutation(n)
    v = np.zeros((n, 12), dtype=np.float32)
    v[:, 0] = 1
    v[:, 1:] = (rep[:, None] >> np.arange(11)) & 1
    v[rep % 100 == 7, 0] = 2
    table = lambda reps, x, **more: pa.table(
        {"rep": pa.array(reps), "v": pa.array(x.tolist(), pa.list_(pa.float32())), **more}
    )
    index = table(rep, v, string=pa.array(np.arange(n)))
    ask = np.zeros((1, 12), dtype=np.float32)
    ask[0, 0] = 1
    asks = table(np.array([5000]), ask, string=pa.array([0]), depth=pa.array([0], pa.int32()))
    got = f._score_ranges(f.PARAMS, keep)(index, asks).to_pydict()
    want = sorted(((-2.0 if k % 100 == 7 else -1.0), k) for k in range(n))[:keep]
    assert sorted((-s, k) for s, k in zip(got["score"], got["found"], strict=True)) == want
