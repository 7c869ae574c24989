import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import minhash_dedup as m
from tests.llm.common import ASCII_LOWER, WORD, documents, messy_rows, sentence


def shingles(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t, _ in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                i, j = sorted((root(i), root(j)))
                up[j] = i
    out = []
    for i, x in sets:
        c = None if i is None else root(i)
        out.append((i, len(x), c, True if i is None else i == c))
    return out


def test_equals_brute_force(spark):
    rows = messy_rows()
    got = [tuple(r) for r in m.near_duplicates(documents(spark, rows, clash=True)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_copies_of_copies_and_hot_group(spark):
    import random

    rng = random.Random(3)
    base = sentence(rng, 150).split()
    rows = [(k, " ".join(base), "a") for k in range(0, 60, 2)]
    for k in range(1, 160, 2):  # near copies of all grades, truncations among them
        w = base[rng.randrange(0, 40) :] if k % 3 else [*base]
        for _ in range(rng.randrange(0, 8)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((200 + k, " ".join(w), "b"))
    got = [tuple(r) for r in m.near_duplicates(documents(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_prefix_pairs_hold_every_link(spark):
    """Sets of all grades of overlap: every pair at the threshold is among the pairs that meet."""
    import random

    rng = random.Random(12)
    sets = []
    for _ in range(12):
        base = [rng.randrange(1 << 40) for _ in range(rng.randrange(4, 60))]
        for _ in range(10):
            own = set(rng.sample(base, rng.randrange(max(1, len(base) * 7 // 10), len(base) + 1)))
            own |= {rng.randrange(1 << 40) for _ in range(rng.randrange(0, 5))}
            sets.append(sorted(own))
    docs = spark.createDataFrame(list(enumerate(sets)), "doc long, shingles array<long>").repartition(5)
    open_ = spark.createDataFrame([(i, i) for i in range(len(sets))], "doc long, comp long")
    for percent in (80, 85, 100):
        met = {tuple(r) for r in m.prefix_pairs(open_, docs, m.NearDupParams(percent=percent)).collect()}
        links = {
            (i, j) for j in range(len(sets)) for i in range(j)
            if 100 * len({*sets[i]} & {*sets[j]}) >= percent * len({*sets[i]} | {*sets[j]})
        }
        assert links <= met and len(met) < len(sets) ** 2 / 8


def test_template_with_fields_forms_few_pairs(spark):
    """20,000 documents of one template, each under the threshold with all others but its twin."""
    n, shared, own = 20_000, 82, 9
    template = F.transform(F.sequence(F.lit(1), F.lit(shared)), lambda k: k.cast("long"))
    # fields are shared by two documents, one more differs: 9 shingles of twins in common
    fields = F.transform(
        F.sequence(F.lit(1), F.lit(own)), lambda k: F.abs(F.xxhash64(F.floor(F.col("id") / 2), k)) + 1000
    )
    last = F.array(F.abs(F.xxhash64("id", F.lit("last"))) + 1000)
    sets = spark.range(n).select(F.col("id").alias("doc"), F.concat(template, fields, last).alias("shingles"))
    open_ = spark.range(n).select(F.col("id").alias("doc"), F.col("id").alias("comp"))
    met = m.prefix_pairs(open_, sets, m.NearDupParams(percent=90))
    twins = met.filter("b = a + 1 and a % 2 = 0").count()
    assert twins == n // 2 and met.count() == twins


def test_rows_that_share_an_id(spark):
    rng = __import__("random").Random(9)
    a, b = sentence(rng, 50), sentence(rng, 50)
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (7, b, "s")]
    got = {(r.doc_id, r.component_id) for r in m.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(1, 1), (5, 1), (7, 1)}


def test_empty_table(spark):
    assert m.near_duplicates(documents(spark, [])).collect() == []


def test_drop_keeps_one_of_each(spark):
    docs = documents(spark, messy_rows(), clash=True)
    out = m.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect() if r.doc_id is not None]
    want = {c for i, _, c, k in brute(messy_rows()) if i is not None and k}
    assert sorted(kept) == sorted(want)


@pytest.mark.parametrize("size", [1, 3, 40, 2000])
def test_sketch_fills_every_bin_and_estimates(size):
    rng = np.random.default_rng(size)
    x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    y = np.concatenate((x[: size * 9 // 10], rng.integers(0, 1 << 63, size - size * 9 // 10, dtype=np.uint64)))
    s = m.fast_sketch(np.concatenate((x, y)), np.array([0, size, 2 * size]), 192, 1)
    assert (s != np.iinfo(np.uint64).max).all()
    true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
    assert abs((s[0] == s[1]).mean() - true) < 0.15
