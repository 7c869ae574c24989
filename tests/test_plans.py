"""Plan-shape checks: what would hurt at scale must not appear in any plan."""

from __future__ import annotations

import pytest

from quire.registry import all_queries
from quire.operators import ranking as R
from quire.registry.common import parts, scored
from tests.conftest import SF_SMALL

# queries whose construction fits models (plans checked elsewhere / not applicable)
FITTING = {
    "als_baseline", "scored_pairs", "als_read", "als_unread", "read_union_scores",
    "lr_elastic_net", "lr_single_feature", "review_scores", "review_blend_scores",
    "combined_scores", "recommend_all_items", "map_all_items", "model_roundtrip", "grid_als",
    "grid_als_read", "grid_lr", "grid_review_blend", "grid_combined", "final_eval",
    "cold_start", "cold_start_pairs", "item_neighbours", "neighbour_curve", "implicit_ranking",
    "feature_tables", "final_eval_read", "final_eval_review", "final_eval_combined",
}

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - FITTING))
def test_no_cross_products_or_python_udfs(spark, name):
    df = all_queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_top_k_limits_before_shuffle(spark):
    """Unclustered input: a partial group limit runs before the exchange."""
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = R.top_k(lines, 5, "l_quantity", group_col="l_partkey", tie_break="l_orderkey")
    plan = _plan(df)
    partial = plan.find("WindowGroupLimit", plan.find("Exchange hashpartitioning(l_partkey"))
    assert partial > 0 and ", Partial" in plan[partial:partial + 300]


def _bounded_top_k(plan: str) -> bool:
    """Above the first user exchange under the window there is a Final limit, and
    either no exchange at all or a Partial limit right below it."""
    win = plan.find("WindowGroupLimit")
    ex = plan.find("Exchange hashpartitioning(user_id", win)
    if win < 0:
        return False
    if ex < 0 or "LeftSemi" in plan[win:ex]:
        return True  # input already clustered by user: no shuffle for the window
    return ", Partial" in plan[ex:ex + 400]


def test_top_k_bounded_on_derived_split(spark):
    from quire.operators import split as S
    from quire.sources import fixtures as FX

    _, val, _ = S.split_recipe(FX.interactions(spark, SF_SMALL))
    assert _bounded_top_k(_plan(R.top_k(scored(val), 500, "prediction")))


def test_top_k_bounded_on_staged_split(spark):
    _, val, _ = parts(spark, SF_SMALL)
    assert _bounded_top_k(_plan(R.top_k(scored(val), 500, "prediction")))


def test_parquet_scan_prunes_and_pushes(spark):
    df = all_queries()["parquet_scan"](spark, SF_SMALL)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,N))]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_split_has_no_shuffle_before_history_check(spark):
    from quire.operators import split as S
    from quire.sources import fixtures as FX

    inter = FX.interactions(spark, SF_SMALL)
    plan = _plan(S.with_split_columns(inter))
    # only the fixture's own join/aggregate shuffles; the split adds none
    assert plan.count("Exchange") == _plan(inter).count("Exchange")
