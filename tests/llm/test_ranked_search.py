import collections
import math
import random
import re

import numpy as np
import pytest

from quire.llm import ranked_search as s
from quire.llm import textkit as tk
from tests.llm.common import ASCII_LOWER, documents, messy_rows, sentence

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = s.SearchParams(keep=4, stages=3, block_docs=7, block_bytes=3000, bundle_items=3, batch_terms=60)


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(items, docs, keep):
    """Every item against every document by the formulas."""
    bags = [(i, collections.Counter(terms(x)), len(terms(x))) for i, x, *_ in docs]
    n_docs, total = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = collections.Counter(w for _, bag, _ in bags for w in bag)
    wanted = collections.defaultdict(set)
    for i, x in items:
        wanted[i] |= set(terms(x))
    out = []
    for i, own in wanted.items():
        found = []
        for d, bag, n in bags:
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * bag[w] // (1000 * bag[w] + 20 * (100 - 50 + 50 * n * n_docs // total)))
                for w in own & bag.keys()
            )
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k, d, -score) for k, (score, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:keep], 1)]
    return sorted(out, key=repr)


def found(spark, items, docs, p):
    frame = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    out = s.search(frame, documents(spark, docs, clash=True), p)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def some_items(rng):
    items = [(k, sentence(rng, rng.randrange(1, 30))) for k in range(12)]
    return items + [(20, None), (21, "..."), (22, "absent words only qqq"), (3, "w1 w2"), (3, "w1 w2"), (None, "w5 W6"),
                    (23, "ÉTÉ über 漢字 W7 w7")]


@pytest.mark.parametrize("p", [s.SearchParams(keep=6), SMALL])
def test_equals_brute_force(spark, p):
    rng = random.Random(6)
    docs = messy_rows() + [(300 + k, sentence(rng, rng.randrange(40)), "e") for k in range(150)]
    docs += [(500, "w1 w2 w3", "t"), (500, "w1 w2 w3", "t"), (400, "w1 w2 w3", "t"), (None, "w1 w2 w3", "t")]  # ties
    items = some_items(rng)
    assert found(spark, items, docs, p) == brute(items, docs, p.keep)


def test_one_group_of_copies_ties(spark):
    """Most documents are equal: ties at the last place go to the smallest ids."""
    docs = [(1000 - k, "w1 w2 common words here", "a") for k in range(400)] + [(5000, "w1 w2 w3", "b")]
    items = [(1, "w1 common"), (2, "w3 w2")]
    assert found(spark, items, docs, SMALL) == brute(items, docs, SMALL.keep)


def test_empty_tables(spark):
    items = [(1, "w1")]
    assert found(spark, items, [], SMALL) == []
    assert found(spark, [], [(1, "w1 w2", "a")], SMALL) == []
    assert found(spark, items, [(1, None, "a"), (2, "", "a")], SMALL) == []


def test_bounds_drop_no_document():
    """The accumulators of a block after all stages hold the best documents of every item."""
    rng = np.random.default_rng(2)
    n_docs, n_terms, keep = 200, 40, 5
    times = rng.integers(0, 4, (n_terms, n_docs)) * (rng.random((n_terms, n_docs)) < np.linspace(0.02, 0.9, n_terms)[:, None])
    sizes = np.maximum(times.sum(axis=0), 1)
    df, most = (times > 0).sum(axis=1), times.max(axis=1)
    items = [np.sort(rng.choice(n_terms, 12, replace=False)) for _ in range(8)]
    p = s.SearchParams(keep=keep)
    plan = s.Plan.of(n_docs, int(sizes.sum()), df, most, items, p)
    assert (plan.ahead[:-1] >= plan.ahead[1:]).all() and (plan.ahead[-1] == 0).all()
    acc = {}
    for stage in range(p.stages):
        own = np.flatnonzero((plan.stage == stage) & (df > 0))
        who = [np.flatnonzero(times[t]) for t in own]
        at = np.concatenate(([0], np.cumsum([len(w) for w in who]))).astype(np.int64)
        flat = np.concatenate(who) if who else np.zeros(0, int)
        acc = s._add(plan, stage, sizes, acc, own, at, flat, np.concatenate([times[t][w] for t, w in zip(own, who)]))
    m = 50 + 50 * sizes * n_docs // sizes.sum()
    for i, terms_ in enumerate(items):
        full = sum(plan.weight[t] * np.where(times[t] > 0, s._parts(times[t], m), 0) for t in terms_)
        best = np.sort(full)[::-1][:keep]
        docs, sums = acc[i]
        assert (full[docs] == sums).all() and (np.sort(sums)[::-1][:keep] == best).all()


def test_words_of_one_hash_are_told_apart():
    v = s.Vocabulary(["abc", "de"])
    buf = np.frombuffer(b"abc de abd", np.uint8)
    v.hashes = np.sort(tk.span_hash(tk.prefix_hash(buf), np.array([7, 4]), np.array([10, 6])))
    found_ = v.find(buf, tk.prefix_hash(buf), np.array([7]), np.array([10]))
    assert found_.tolist() == [-1]
