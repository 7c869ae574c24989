"""Fixtures and brute-force helpers of these tests."""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOC_COLUMNS = [
    ("doc_id", T.LongType()),
    ("text", T.StringType()),
    ("lang", T.StringType()),
    ("source", T.StringType()),
    ("n_chars", T.LongType()),
]
#: names that the operators use inside
CLASHING = ["n_words", "kept", "bucket", "row", "rep", "size", "target", "doc", "words", "rest", "idx", "offset", "v"]


def documents(spark, rows, clash: bool = False):
    """rows: (doc_id, text, source)."""
    cols = DOC_COLUMNS + [(c, T.StringType()) for c in CLASHING] * clash
    schema = T.StructType([T.StructField(n, t) for n, t in cols])
    full = [
        (i, t, "en", s, None if t is None else len(t), *(["x"] * len(CLASHING) if clash else [])) for i, t, s in rows
    ]
    return spark.createDataFrame(full, schema).repartition(3)


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def messy_rows(seed: int = 5):
    """Nulls, empty and very long texts, repeated rows, exact and near copies, shared passages."""
    rng = random.Random(seed)
    base = sentence(rng, 200)
    passage = sentence(rng, 40)
    rows = [
        (1, base, "a"),
        (2, base, "b"),
        (2, base, "b"),
        (3, base.replace("w1", "zz", 1), None),
        (4, None, "a"),
        (5, "", "a"),
        (6, " \t\n ", "c"),
        (7, "one two", "c"),
        (8, "ONE two", "c"),
        (9, sentence(rng, 60_000, 5000), "a"),
        (10, "été über ñandú 漢字 😀 " * 8, "b"),
        (None, base, "a"),
        (None, None, None),
        (11, "same line here\n" * 40, "c"),
    ]
    rows += [(20 + k, sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 30), "d") for k in range(12)]
    words = base.split()
    for k in range(12):  # a chain of edits: neighbours alike, ends not
        words = [*words]
        for _ in range(3):
            words[rng.randrange(len(words))] = f"e{k}{rng.randrange(99)}"
        rows.append((50 + k, " ".join(words), "a"))
    return rows


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def table(rows, columns):
    """Rows as sorted tuples over the sorted columns."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])


def collected(df):
    return table([tuple(r) for r in df.collect()], df.columns)
