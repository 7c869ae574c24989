"""H: sampling and splitting; C1/C2/C7/C9 membership joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import ranking as R
from quire.operators import split as S
from quire.registry.common import ICOLS, _hb, interactions, parts, sql_with

SAMPLE_FRACTION = 0.25


def sample_users(spark, sf_dir):
    return S.sample_users(interactions(spark, sf_dir), SAMPLE_FRACTION)


def sampled_user_semi(spark, sf_dir):
    inter = interactions(spark, sf_dir)
    users = S.sample_users(inter.select("user_id").distinct(), SAMPLE_FRACTION)
    return inter.join(users, "user_id", "left_semi")


def split_users(spark, sf_dir):
    return S.split_users(interactions(spark, sf_dir))


def split_membership(spark, sf_dir):
    inter = interactions(spark, sf_dir)
    return inter.join(S.split_users(inter), "user_id")


def half_rows(spark, sf_dir):
    return S.half_rows(interactions(spark, sf_dir))


def half_exact(spark, sf_dir):
    rows = S.with_split_columns(interactions(spark, sf_dir)).where(F.col("part") != "train")
    return S.exact_half(rows.drop("part", "half"))


def split_recipe(spark, sf_dir):
    return S.split_table(interactions(spark, sf_dir))


def truth_lists(spark, sf_dir):
    """Held-out truth of validation and test in long form: every row ranked by rating."""
    _, val, test = parts(spark, sf_dir)
    held = val.withColumn("part", F.lit("val")).unionByName(test.withColumn("part", F.lit("test")))
    rel = held.select("part", "user_id", "book_id", "rating")  # a user is in one part only
    return R.rank_by_value(rel, "user_id", "rating", out="true_row")


def split_report(spark, sf_dir):
    return S.split_report(interactions(spark, sf_dir))


def min_activity(spark, sf_dir):
    return S.min_activity(interactions(spark, sf_dir), 10)


def seen_items_only(spark, sf_dir):
    train, val, _ = parts(spark, sf_dir)
    return S.seen_items_only(val, train)


def history_semi(spark, sf_dir):
    rows = S.with_split_columns(interactions(spark, sf_dir))
    held = rows.where((F.col("part") != "train") & (F.col("half") == 1))
    observed = rows.where((F.col("part") != "train") & (F.col("half") == 0))
    return S.with_history(held, observed).drop("part", "half")


def history_overlap(spark, sf_dir):
    """Held-out users with / without observed history (the 1751 vs 37 diagnostic)."""
    rows = S.with_split_columns(interactions(spark, sf_dir)).where(F.col("part") != "train")
    held_users = rows.where(F.col("half") == 1).select("user_id", "part").distinct()
    obs_users = rows.where(F.col("half") == 0).select("user_id").distinct()
    with_h = held_users.join(obs_users, "user_id", "left_semi").withColumn("has_history", F.lit(1))
    without = held_users.join(obs_users, "user_id", "left_anti").withColumn(
        "has_history", F.lit(0)
    )
    return (
        with_h.unionByName(without)
        .groupBy("part", "has_history")
        .agg(F.countDistinct("user_id").alias("n_users"))
    )


QUERIES = {
    "sample_users": sample_users,
    "sampled_user_semi": sampled_user_semi,
    "split_users": split_users,
    "split_membership": split_membership,
    "half_rows": half_rows,
    "half_exact": half_exact,
    "split_recipe": split_recipe,
    "truth_lists": truth_lists,
    "split_report": split_report,
    "min_activity": min_activity,
    "seen_items_only": seen_items_only,
    "history_semi": history_semi,
    "history_overlap": history_overlap,
}

_SAMPLE_PRED = f"{_hb("concat('2020s:', user_id)")} % 10000 < 2500"
_PART = (
    "case when ub < 6 then 'train' when ub < 8 then 'val' else 'test' end"
)

ORACLE = {
    "sample_users": sql_with(f"select * from interactions where {_SAMPLE_PRED}", "interactions"),
    "sampled_user_semi": sql_with(
        f"select * from interactions where {_SAMPLE_PRED}", "interactions"
    ),
    "split_users": sql_with(
        f"""select user_id, {_PART} as part
            from (select user_id, {_hb("concat('2020:', user_id)")} % 10 as ub
                  from (select distinct user_id from interactions) u) x""",
        "interactions",
    ),
    "split_membership": sql_with(
        f"select {ICOLS}, part from split_rows", "split_rows"
    ),
    "half_rows": sql_with(f"select {ICOLS}, half from split_rows", "split_rows"),
    "half_exact": sql_with(
        f"""select {ICOLS},
                   case when rn <= ceil(n / 2.0) then 0 else 1 end as half
            from (select *,
                         row_number() over (partition by user_id order by h, book_id) as rn,
                         count(*) over (partition by user_id) as n
                  from (select *, {_hb("concat('2020:', user_id, ':', book_id)")} as h
                        from split_rows where part <> 'train') a) b""",
        "split_rows",
    ),
    "split_recipe": sql_with(
        f"""select {ICOLS}, 'train' as part from train
            union all select {ICOLS}, 'val' as part from val
            union all select {ICOLS}, 'test' as part from test""",
        "train",
        "val",
        "test",
    ),
    "truth_lists": sql_with(
        """select part, user_id, book_id, rating,
                  cast(rank() over (partition by user_id order by rating desc) as int) as true_row
           from (select 'val' as part, * from val union all select 'test' as part, * from test) h""",
        "val",
        "test",
    ),
    "split_report": sql_with(
        """select part, half, count(*) as n_rows, count(distinct user_id) as n_users
           from split_rows group by part, half""",
        "split_rows",
    ),
    "min_activity": sql_with(
        """select * from interactions
           where user_id in (select user_id from interactions group by user_id
                             having count(*) >= 10)""",
        "interactions",
    ),
    "seen_items_only": sql_with(
        "select * from val where book_id in (select book_id from train)", "train", "val"
    ),
    "history_semi": sql_with(
        f"""select {ICOLS} from split_rows
            where part <> 'train' and half = 1
              and user_id in (select user_id from split_rows where part <> 'train' and half = 0)""",
        "split_rows",
    ),
    "history_overlap": sql_with(
        """select part, has_history, count(distinct user_id) as n_users
           from (select distinct h.user_id, h.part,
                        case when h.user_id in (select user_id from split_rows
                                                where part <> 'train' and half = 0)
                             then 1 else 0 end as has_history
                 from split_rows h where h.part <> 'train' and h.half = 1) x
           group by part, has_history""",
        "split_rows",
    ),
}
