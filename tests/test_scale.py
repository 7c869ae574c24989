"""Shuffles sized by their input, and joins that do not move texts more often than they must."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.operators import split as S
from quire.registry import extensions, joins, scalar
from quire.registry.common import parts
from quire.session import shuffles_for
from quire.sources import fixtures as FX
from tests.conftest import SF_SMALL

KEY = "spark.sql.shuffle.partitions"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_shuffles_follow_the_rows(spark):
    before = spark.conf.get(KEY)
    with shuffles_for(spark, 10_000_001, 1_000_000):
        assert spark.conf.get(KEY) == "11"
    assert spark.conf.get(KEY) == before
    with shuffles_for(spark, 10):
        assert spark.conf.get(KEY) == before
    with pytest.raises(ZeroDivisionError), shuffles_for(spark, 10**9):
        raise ZeroDivisionError
    assert spark.conf.get(KEY) == before


def test_derived_tables_are_built_with_shuffles_of_their_size(spark, monkeypatch):
    """The number of line items decides, and the session's setting comes back."""
    asked = []

    def noted(session, rows, *a):
        asked.append(rows)
        return shuffles_for(session, rows, *a)

    monkeypatch.setattr(FX, "shuffles_for", noted)
    monkeypatch.setattr(extensions, "shuffles_for", noted)
    FX._STAGED.clear()
    parts(spark, SF_SMALL)
    n = FX.load(spark, SF_SMALL, "lineitem").count()
    assert asked == [n, n]
    extensions.distinct_sketches(spark, SF_SMALL).collect()
    assert len(asked) == 3 and asked[-1] > 0


def test_texts_meet_their_ids_once(spark):
    raw = spark.createDataFrame(
        [("a", "x", 1.0, "t1", "r1"), ("a", "x", 2.0, "t2", "r2"), ("b", "y", 3.0, None, "r3"), ("c", "x", 1.0, "t4", "r4"),
         (None, "x", 1.0, "t5", "r5")],
        "user_id string, book_id string, rating double, review_text string, review_id string",
    )
    users = spark.createDataFrame([(1, "a"), (2, "b"), (7, "a"), (9, None)], "user_id_csv int, user_id string")
    books = spark.createDataFrame([(3, "x"), (4, "y")], "book_id_csv int, book_id string")
    out = joins.map_ids(raw, users, books)
    got = sorted((r.user_id, r.book_id, r.review_id, r.review_text) for r in out.collect())
    assert got == [(1, 3, "r1", "t1"), (1, 3, "r2", "t2"), (2, 4, "r3", None), (7, 3, "r1", "t1"), (7, 3, "r2", "t2")]
    # below the first join only pairs of ids meet the maps
    lines = plan(out).splitlines()
    at = [i for i, line in enumerate(lines) if "Join" in line]
    assert len(at) == 3 and any("Aggregate [user_id" in line and "review_text" not in line for line in lines[at[2] :])


def test_scores_of_reviews_are_joined_without_texts(spark):
    _, val, _ = parts(spark, SF_SMALL)
    side = scalar.review_side(spark, SF_SMALL, val.withColumn("rating", F.col("rating").cast("float")))
    lines = plan(side.select("user_id", "prediction")).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = [line for line in lines[join + 1 :] if "Project" in line and "prediction" in line]
    assert below and "length(review_text" in below[0]


def test_rows_are_hashed_once_for_the_split_table(spark):
    rows = [(u, b, 1, 3.0, 0) for u in [*range(40), None] for b in [*range(6), None]]
    df = spark.createDataFrame(rows, "user_id int, book_id int, is_read int, rating double, is_reviewed int")
    table = S.split_table(df)
    assert "md5" not in plan(table)  # three branches read the hashes
    got = sorted(map(str, table.collect()))
    parts_ = [p.withColumn("part", F.lit(n)) for n, p in zip(("train", "val", "test"), S.split_recipe(df))]
    assert got == sorted(str(r) for p in parts_ for r in p.collect())
