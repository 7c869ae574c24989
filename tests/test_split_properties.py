"""Split properties: layout invariance, disjoint and complete parts, history kept."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire.operators import split as S
from quire.sources import fixtures as FX
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def inter(spark):
    return FX.interactions(spark, SF_SMALL).cache()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n", [1, 4, 13])
def test_layout_invariance(inter, n):
    base = _rows(S.split_table(inter))
    assert _rows(S.split_table(inter.repartition(n))) == base
    assert _rows(S.sample_users(inter.repartition(n), 0.25)) == _rows(S.sample_users(inter, 0.25))
    ex = S.exact_half(inter.repartition(n))
    assert _rows(ex) == _rows(S.exact_half(inter))


def test_parts_disjoint_and_complete(inter):
    table = S.split_table(inter)
    assert table.count() <= inter.count()
    keyed = table.groupBy("user_id", "book_id").count()
    assert keyed.where("count > 1").count() == 0
    # every interaction is either in a part or belongs to a held-out user without history
    missing = inter.join(table, ["user_id", "book_id"], "left_anti")
    rows = S.with_split_columns(missing)
    assert rows.where("part = 'train' or half = 0").count() == 0


def test_held_out_users_have_history(inter):
    train, val, test = S.split_recipe(inter)
    for part in (val, test):
        assert part.join(train, "user_id", "left_anti").count() == 0
        assert part.join(train, ["user_id", "book_id"], "inner").count() == 0


def test_users_in_one_part(inter):
    parts = S.split_users(inter)
    assert parts.groupBy("user_id").count().where("count > 1").count() == 0
    frac = parts.groupBy("part").count().collect()
    assert {r.part for r in frac} == {"train", "val", "test"}


def test_exact_half_keeps_history(inter):
    ex = S.exact_half(inter)
    per = ex.groupBy("user_id").agg(
        F.sum(F.when(F.col("half") == 0, 1).otherwise(0)).alias("obs"), F.count("*").alias("n")
    )
    assert per.where("obs < 1 or obs != ceil(n / 2.0)").count() == 0


def test_min_activity(inter):
    kept = S.min_activity(inter, 10)
    assert kept.groupBy("user_id").count().where("count < 10").count() == 0
