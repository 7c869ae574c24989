"""K: RMSE, MAP, precision / recall / NDCG @k, coverage (on deterministic scores)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quire.operators import metrics as M
from quire.operators import models as MD
from quire.operators import ranking as R
from quire.registry.common import parts, r6, scored, sql_with
from quire.registry.scalar import COLD_SQL, cold_item

K = 5


def _top_positions(val, k=K):
    top = R.top_k(scored(val), k, "prediction", method="row_number", out="row_num")
    return top.select("user_id", "book_id", "row_num")


def _relevant(val):
    return val.where(F.col("rating") >= 4).select("user_id", "book_id")


def rmse_topk(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), K, "prediction", method="rank", out="rank")
    return M.rmse(top).select(r6("rmse"), "n")


def rmse_all(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    shifted = scored(val).withColumn("prediction", F.col("prediction") - 1.0)
    clamped = shifted.withColumn(
        "prediction", F.when(F.col("prediction") < 0, 0.0).otherwise(F.col("prediction"))
    )
    return M.rmse(clamped).select(r6("rmse"), "n")


def rmse_by_flag(spark, sf_dir):
    """RMSE per is_read flag and overall (rollup), on the top-500 rows."""
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), 500, "prediction", method="rank", out="rank")
    out = M.rmse_by_flag(top)
    flag = F.coalesce(F.col("is_read").cast("string"), F.lit("all")).alias("is_read")
    return out.select(flag, r6("rmse"), "n")


def _metrics(spark, sf_dir):
    _, val, _ = parts(spark, sf_dir)
    return M.ranking_metrics(_top_positions(val), _relevant(val), k=K)


def map_lists(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("map"), "n_users")


def precision_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("precision_at_k"), "n_users")


def recall_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("recall_at_k"), "n_users")


def ndcg_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("ndcg_at_k"), "n_users")


def map_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("map_at_k"), "n_users")


CUTOFFS = (1, 3, 5, 10, 25)


def metrics_at_cutoffs(spark, sf_dir):
    """MAP, precision, recall and NDCG at several cutoffs from one top-k."""
    _, val, _ = parts(spark, sf_dir)
    out = M.ranking_curve(_top_positions(val, max(CUTOFFS)), _relevant(val), CUTOFFS)
    return out.select("k", *[r6(c) for c in ("map_at_k", "precision_at_k", "recall_at_k", "ndcg_at_k")], "n_users")


def get_map(spark, sf_dir):
    """Held-out-candidate protocol: rank <= k over held-out pairs vs all held-out pairs."""
    _, val, _ = parts(spark, sf_dir)
    top = R.top_k(scored(val), K, "prediction", method="rank", out="row_num")
    truth = R.rank_by_value(val.select("user_id", "book_id", "rating"), out="true_row")
    return M.get_map(top.select("user_id", "book_id", "row_num"), truth).select(
        r6("map"), "n_users"
    )


def coverage(spark, sf_dir):
    """Cold-start coverage: held-out pairs an ALS model could score when cold items
    are withheld from training (user and item both seen in training)."""
    train, val, _ = parts(spark, sf_dir)
    scorable = MD.scorable_pairs(val, train.where(~cold_item()))
    return M.coverage(scorable, val).select(r6("coverage"), "n_users")


QUERIES = {
    "rmse_topk": rmse_topk,
    "rmse_all": rmse_all,
    "rmse_by_flag": rmse_by_flag,
    "map_lists": map_lists,
    "get_map": get_map,
    "precision_at_k": precision_at_k,
    "recall_at_k": recall_at_k,
    "ndcg_at_k": ndcg_at_k,
    "map_at_k": map_at_k,
    "metrics_at_cutoffs": metrics_at_cutoffs,
    "coverage": coverage,
}


def _ranking_ctes(k: int = K) -> dict[str, str]:
    return {
        "top": f"""select user_id, book_id, pos from (
                       select user_id, book_id,
                              row_number() over (partition by user_id
                                                 order by prediction desc, book_id) as pos
                       from val_scored) x where pos <= {k}""",
        "rel": "select distinct user_id, book_id from val where rating >= 4",
        "nt": "select user_id, count(*) as n_truth from rel group by user_id",
        "np": "select distinct user_id from top",
        "hits": """select t.user_id, t.pos,
                          row_number() over (partition by t.user_id order by t.pos) as cum
                   from top t join rel r using (user_id, book_id)""",
        "ideal": f"""select i as m,
                            sum(1.0 / log2(i + 1)) over (order by i) as idcg
                     from range(1, {k + 1}) t(i)""",
        "per_user": f"""
            select nt.user_id, nt.n_truth,
                   coalesce(sum(h.cum * 1.0 / h.pos), 0) / nt.n_truth as ap,
                   coalesce(sum(h.cum * 1.0 / h.pos), 0) / least(nt.n_truth, {k}) as apk,
                   count(h.pos) * 1.0 / {k} as pk,
                   count(h.pos) * 1.0 / nt.n_truth as rk,
                   coalesce(sum(1.0 / log2(h.pos + 1)), 0)
                       / max(ideal.idcg) as ndcg
            from nt join np using (user_id)
            join ideal on ideal.m = least(nt.n_truth, {k})
            left join hits h using (user_id)
            group by nt.user_id, nt.n_truth""",
    }


def _metric_sql(expr: str, name: str) -> str:
    return sql_with(
        f"select round(avg({expr}), 6) as {name}, count(*) as n_users from per_user",
        "val_scored",
        extra=_ranking_ctes(),
    )


def _cutoffs_sql() -> str:
    """The per-user CTEs of each cutoff under names of their own."""
    extra, rows = {}, []
    names = ("top", "rel", "nt", "np", "hits", "ideal", "per_user")
    for k in CUTOFFS:
        for name, q in _ranking_ctes(k).items():
            for other in names:
                q = re.sub(rf"\b(from|join) {other}\b", rf"\1 {other}_{k}", q)
            extra[f"{name}_{k}"] = q.replace("ideal.", f"ideal_{k}.").replace("nt.", f"nt_{k}.")
        rows.append(f"""select {k} as k, round(avg(apk), 6) as map_at_k, round(avg(pk), 6) as precision_at_k,
                               round(avg(rk), 6) as recall_at_k, round(avg(ndcg), 6) as ndcg_at_k, count(*) as n_users
                        from per_user_{k}""")
    return sql_with(" union all ".join(rows), "val_scored", extra=extra)


ORACLE = {
    "metrics_at_cutoffs": _cutoffs_sql(),
    "rmse_topk": sql_with(
        f"""select round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse,
                   count(*) as n
            from (select *, rank() over (partition by user_id order by prediction desc) as rk
                  from val_scored) x where rk <= {K}""",
        "val_scored",
    ),
    "rmse_all": sql_with(
        """select round(sqrt(avg((p - rating) * (p - rating))), 6) as rmse, count(*) as n
           from (select rating,
                        case when prediction - 1.0 < 0 then 0.0 else prediction - 1.0 end as p
                 from val_scored) x""",
        "val_scored",
    ),
    "rmse_by_flag": sql_with(
        """select coalesce(cast(is_read as varchar), 'all') as is_read,
                  round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse,
                  count(*) as n
           from (select *, rank() over (partition by user_id order by prediction desc) as rk
                 from val_scored) x
           where rk <= 500
           group by rollup(is_read)""",
        "val_scored",
    ),
    "map_lists": _metric_sql("ap", "map"),
    "precision_at_k": _metric_sql("pk", "precision_at_k"),
    "recall_at_k": _metric_sql("rk", "recall_at_k"),
    "ndcg_at_k": _metric_sql("ndcg", "ndcg_at_k"),
    "map_at_k": _metric_sql("apk", "map_at_k"),
    "get_map": sql_with(
        f"""select round(avg(ap), 6) as map, count(*) as n_users from (
              select nt.user_id, coalesce(sum(h.cum * 1.0 / h.pos), 0) / nt.n_truth as ap
              from (select user_id, count(*) as n_truth
                    from (select distinct user_id, book_id from val) d group by user_id) nt
              join (select distinct user_id from top) np using (user_id)
              left join (select t.user_id, t.pos,
                                row_number() over (partition by t.user_id order by t.pos) as cum
                         from top t join (select distinct user_id, book_id from val) r
                           using (user_id, book_id)) h using (user_id)
              group by nt.user_id, nt.n_truth) x""",
        "val_scored",
        extra={
            "top": f"""select user_id, book_id,
                              row_number() over (partition by user_id
                                                 order by rk, book_id) as pos
                       from (select *, rank() over (partition by user_id
                                                    order by prediction desc) as rk
                             from val_scored) x where rk <= {K}"""
        },
    ),
    "coverage": sql_with(
        f"""select round(avg(coalesce(s.n, 0) * 1.0 / h.n), 6) as coverage, count(*) as n_users
            from (select user_id, count(*) as n from val group by user_id) h
            left join (select user_id, count(*) as n from val
                       where user_id in (select user_id from warm)
                         and book_id in (select book_id from warm)
                       group by user_id) s using (user_id)""",
        "train",
        "val",
        extra={"warm": f"select * from train where not ({COLD_SQL})"},
    ),
}
