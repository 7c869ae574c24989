import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quire.llm import toxicity as x
from tests.llm.common import documents, messy_rows, sentence

LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
)


def corpus():
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        words = sentence(rng, rng.randrange(20, 200), 300).split()
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "Rotten", "nasty"]))
        rows.append((k, " ".join(words), "a"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, table = documents(spark, rows, clash=True), spark.createDataFrame(labels, LABELS)
    got = x.classify(docs, table).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_word_families_are_found(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(600):
        words = sentence(rng, rng.randrange(20, 200), 300).split()
        toxic = k % 5 == 0
        if toxic:  # no whole word of the family comes back
            words[5:5] = [f"réêoux{k}x{j}" for j in range(4)]
        rows.append((k, " ".join(words), "a"))
        labels.append((k, 1, int(toxic)))
    got = x.classify(documents(spark, rows), spark.createDataFrame(labels, LABELS)).filter("held_out").collect()
    assert sum(r.predicted for r in got if r.doc_id % 5 == 0) >= 0.95 * sum(r.doc_id % 5 == 0 for r in got)
    assert not any(r.predicted for r in got if r.doc_id % 5)


def test_stems_are_characters():
    texts = ["Réêouxa reeuxab x", "réêouxb 漢字漢字漢字漢 reeuxac", "", "réêoux reeux"]
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
    tokens, first = x.token_hashes(buf, np.cumsum([0, *map(len, raw)]), (6,))
    words = [w for t in texts for w in t.split()]
    assert first.tolist() == [0, 3, 6, 6, 8] and tokens.shape == (2, 8)
    low = [w.lower() for w in words]
    for i, a in enumerate(low):
        for j, b in enumerate(low):
            assert (tokens[0, i] == tokens[0, j]) == (a == b) and (tokens[1, i] == tokens[1, j]) == (a[:6] == b[:6])
    assert not set(tokens[0].tolist()) & set(tokens[1].tolist())


def test_held_out_labels_are_not_used(spark):
    rows, labels = corpus()
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    docs = documents(spark, rows)
    a, b = (
        {r.doc_id: r.score for r in x.classify(docs, spark.createDataFrame(lab, LABELS)).collect()}
        for lab in (labels, other)
    )
    assert a == b


def test_odd_rows(spark):
    labels = [(1, 1, 1), (2, 1, 0), (2, 1, None), (None, 1, 1), (20, 0, 0), (21, 0, 1), (9, 1, 0)]
    docs = documents(spark, messy_rows(), clash=True)
    got = x.classify(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r.score <= 1 for r in got)
    for none in ([], [(1, 1, None)]):
        got = x.classify(docs, spark.createDataFrame(none, LABELS)).collect()
        assert len({r.score for r in got}) == 1 and not any(r.predicted for r in got)
    assert x.classify(documents(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []


def slow_segments(scores):
    """Best run first (the shortest of equals), then the same left and right of it."""
    best = max(
        ((sum(scores[b:e]), -(e - b), -b, b, e) for b in range(len(scores)) for e in range(b + 1, len(scores) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    _, _, _, b, e = best
    left, right = slow_segments(scores[:b]), slow_segments(scores[e:])
    return left + [(b, e)] + [(s + e, t + e) for s, t in right]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-50, 50).map(lambda v: v + 0.125 * (v % 7)), max_size=14))
def test_segments_equal_their_definition(scores):
    a = np.array(scores, dtype=float)
    got = x.all_segments(a)
    want = slow_segments(scores)
    assert sorted(round(s, 6) for _, _, s in got) == sorted(round(sum(scores[b:e]), 6) for b, e in want)
    assert x.best_segment(a) == max([s for _, _, s in got], default=0.0) or abs(
        x.best_segment(a) - max(s for _, _, s in got)
    ) < 1e-9
