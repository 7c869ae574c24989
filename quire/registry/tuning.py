"""L: grid searches, final evaluation, leaderboard; D10 / D11; A5 / A6 sinks.

Two families:

* ``eval_grid`` and the queries on its results (winners, pivot, leaderboard,
  result sinks) use the deterministic stand-in scorer so they can be checked
  against SQL.  All configurations are evaluated in ONE job: each held-out row
  is expanded over the configuration array (a generator, not a join) and the
  evaluation groups by the configuration columns.
* ``grid_*`` / ``final_eval*`` run the real model grids (ALS, LR) with small
  grids; checked are the scored pairs, users and coverage per configuration,
  and MAP where it follows from them (every candidate is a held-out pair).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket, typed_interactions
from quire.operators import models as MD
from quire.operators.split import SAMPLE_BUCKETS
from quire.plans import tune as TU
from quire.plans.evaluate import evaluate_cutoffs
from quire.registry.common import _hb, parts, r6, scored, sql_with
from quire.registry.models import _review_features, read_features
from quire.session import scratch_path

VARIANTS = ("score", "inverse")
SHIFTS = (0.0, 0.5, 1.0)
KS = (5, 25)
MAX_SCORE = 4.995
CONFIG = ("k", "shift")


def _eval_grid_df(spark, sf_dir, samples=(100,)):
    _, val, _ = parts(spark, sf_dir)
    cfgs = F.array(
        *[
            F.struct(
                F.lit(v).alias("variant"), F.lit(s).alias("shift"), F.lit(str(n)).alias("sample"),
                F.lit(_sample_cut(n)).alias("cut"),
            )
            for v in VARIANTS
            for s in SHIFTS
            for n in samples
        ]
    )
    base = scored(val).withColumn("cfg", F.explode(cfgs)).select(
        "user_id", "book_id", "rating", "prediction", "cfg.*"
    )
    in_sample = hash_bucket("2020s", "user_id") % SAMPLE_BUCKETS < F.col("cut")
    base = base.where(in_sample).drop("cut")
    raw = F.when(F.col("variant") == "score", F.col("prediction")).otherwise(
        F.lit(MAX_SCORE) - F.col("prediction")
    )
    shifted = raw - F.col("shift")
    pred = base.withColumn(
        "prediction", F.when(shifted < 0, F.lit(0.0)).otherwise(shifted)
    )
    out = evaluate_cutoffs(pred, val, KS, relevant_min=4, config_cols=("variant", "shift", "sample"))
    return out.select(
        "variant",
        "sample",
        "k",
        "shift",
        "rmse",
        "map",
        "coverage",
        "n_rows",
    )


def eval_grid(spark, sf_dir):
    g = _eval_grid_df(spark, sf_dir)
    return g.select("variant", "sample", "k", "shift", r6("rmse"), r6("map"), r6("coverage"),
                    "n_rows")


def best_config(spark, sf_dir):
    out = TU.best_config(_eval_grid_df(spark, sf_dir), config=CONFIG)
    return out.select(*[r6(c) if c in ("best_rmse", "best_map") else F.col(c)
                        for c in out.columns])


def grid_pivot(spark, sf_dir):
    out = TU.grid_pivot(_eval_grid_df(spark, sf_dir), list(SHIFTS), "rmse",
                        rows=("variant", "sample", "k"), pivot="shift")
    return out.select(*[r6(c) if c.startswith("shift_") else F.col(c) for c in out.columns])


SAMPLES = (1, 5, 25, 100)  # percent of users


def _sample_cut(percent: int) -> int:
    return percent * SAMPLE_BUCKETS // 100


def leaderboard(spark, sf_dir):
    """Variant x sample leaderboard: hash samples of the users, one result file per sample.

    The files have the headerless layout; k and shift stand in its iteration
    and regularisation columns.
    """
    path = scratch_path(spark, "sweep")
    grid = _eval_grid_df(spark, sf_dir, SAMPLES)
    grid = TU.cached(grid)
    results = None
    for variant in VARIANTS:
        for s in SAMPLES:
            one = grid.where((F.col("variant") == variant) & (F.col("sample") == str(s)))
            rows = one.select(F.col("k").alias("max_iter"), F.lit(0).alias("rank"),
                              F.col("shift").alias("reg"), "rmse", "map")
            TU.write_results_csv(rows, f"{path}/{variant}-{s}")
            back = TU.read_results_csv(spark, f"{path}/{variant}-{s}", variant, str(s))
            results = back if results is None else results.unionByName(back)
    grid.unpersist()
    out = TU.leaderboard(results)
    return out.select("variant", "sample", r6("best_rmse"), F.col("rmse_max_iter").alias("rmse_k"),
                      F.col("rmse_reg").alias("rmse_shift"), r6("best_map"),
                      F.col("map_max_iter").alias("map_k"), F.col("map_reg").alias("map_shift"))


def results_append(spark, sf_dir):
    """Two runs appended to one results table, the first of them twice, read back."""
    path = scratch_path(spark, "results")
    g = _eval_grid_df(spark, sf_dir).select("variant", "sample", "k", "shift", "rmse", "map")
    runs = g.withColumn("run", F.lit(1))
    for run in (1, 2, 1):
        TU.commit_results(g.withColumn("run", F.lit(run)), path, ["run", "variant", "sample", "k", "shift"])
    back = TU.read_results(spark, path, runs.schema)
    return back.select("run", "variant", "sample", "k", "shift", r6("rmse"), r6("map"))


def results_headerless_scan(spark, sf_dir):
    """Results written as headerless CSV and read back with named columns."""
    path = scratch_path(spark, "results-csv")
    g = _eval_grid_df(spark, sf_dir)
    cols = ["k", "shift", "rmse", "map"]
    g.select(*[F.col(c).cast("double") for c in cols]).write.option("header", False).csv(path)
    schema = ", ".join(f"{c} double" for c in cols)
    back = spark.read.schema(schema).option("header", False).csv(path)
    return back.select(F.col("k").cast("int").alias("k"), "shift", r6("rmse"), r6("map"))


# -- real model grids ---------------------------------------------------------
#
# Model scores have no SQL counterpart; what follows from the data alone has:
# which pairs are scored, how many per configuration, and their coverage.  The
# registered grids are cut to a few points and few iterations; the grid, its
# ledger (``sink``) and the number of fits at a time are arguments.

GRID = TU.als_grid([5], [10], [0.05, 0.1])
LR_GRID = ([0.1, 0.2], [0.01])

# The grids of the original study (fixed values): 63, 10 and 35 points.
FULL_GRID = TU.als_grid([20], [8, 10, 12, 14, 16, 18, 20], [0.001, 0.01, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8, 1.0])
FULL_REVIEW_GRID = TU.als_grid([20], [10, 20], [0.01, 0.05, 0.1, 0.2, 0.5])
FULL_LR_GRID = ([0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5], [0.001, 0.01, 0.05, 0.1, 0.2])
READ_UNREAD = MD.UNREAD_PARAMS


def _grid_rows(results, *more):
    """Configurations with what each evaluated; the metrics must be defined and in range."""
    valid = (F.col("rmse") >= 0) & F.col("map").between(0, 1)
    return results.select(
        "variant", "max_iter", "rank", "reg", *more, "n_rows", "n_users", r6("coverage"),
        F.coalesce(valid, F.lit(False)).cast("int").alias("valid"),
    )


def grid_als(spark, sf_dir, grid=None, **ledger):
    train, val, _ = parts(spark, sf_dir)
    scorer = TU.baseline_scorer(train, val)
    return _grid_rows(TU.grid_search(spark, grid or GRID, scorer, val, "baseline", "100", **ledger))


def grid_als_read(spark, sf_dir, grid=None, **ledger):
    train, val, _ = parts(spark, sf_dir)
    scorer = TU.read_scorer(train, val, READ_UNREAD)
    return _grid_rows(TU.grid_search(spark, grid or GRID, scorer, val, "read", "100", **ledger))


def _lr_results(spark, tr_f, va_f, regs, nets, **ledger):
    return TU.lr_grid(spark, tr_f, va_f, regs, nets, "100", k=25, **ledger)


def grid_lr(spark, sf_dir, regs=LR_GRID[0], nets=LR_GRID[1], **ledger):
    _, (tr_f, va_f, _) = _review_features(spark, sf_dir)
    return _grid_rows(_lr_results(spark, tr_f, va_f, regs, nets, **ledger), "net")


def _review_scorers(spark, sf_dir, variant):
    """(scorer, pairs) for validation and test: the regression is the LR grid's winner."""
    (train, val, test), (tr_f, va_f, te_f) = _review_features(spark, sf_dir)
    if variant == "combined":  # learns from and scores reviews of read rows only
        tr_f, va_f, te_f = (read_features(f) for f in (tr_f, va_f, te_f))
    fitted: dict = {}
    best = TU.lr_winner(_lr_results(spark, tr_f, va_f, *LR_GRID, models=fitted))
    model = fitted[best] if best in fitted else MD.fit_lr(tr_f, *best)
    out, models = [], TU.Models(train)
    for feats, pairs in ((va_f, val), (te_f, test)):
        typed, review = typed_interactions(pairs), MD.review_predictions(model, feats)
        if variant == "combined":
            scorer = TU.combined_scorer(train, typed, review, READ_UNREAD, models)
        else:
            scorer = TU.review_blend_scorer(train, typed, review, models)
        out.append((scorer, typed))
    return out


def _review_grid(spark, sf_dir, variant, grid, **ledger):
    (scorer, pairs), _ = _review_scorers(spark, sf_dir, variant)
    return _grid_rows(TU.grid_search(spark, grid or GRID, scorer, pairs, variant, "100", **ledger))


def grid_review_blend(spark, sf_dir, grid=None, **ledger):
    return _review_grid(spark, sf_dir, "review", grid, **ledger)


def grid_combined(spark, sf_dir, grid=None, **ledger):
    return _review_grid(spark, sf_dir, "combined", grid, **ledger)


def _final(spark, variant, val, test, grid, **ledger):
    m = TU.tune_and_test(spark, grid or GRID, val, test, variant, "100", **ledger)
    valid = (F.col("rmse") >= 0) & F.col("map").between(0, 1)
    return m.select(
        "variant", F.lit("test").alias("split"), "n_rows", "n_users", r6("coverage"), r6("map"),
        F.coalesce(valid, F.lit(False)).cast("int").alias("valid"),
    )


def final_eval(spark, sf_dir, grid=None):
    """Baseline: grid on validation, winner by RMSE, its evaluation on the test pairs."""
    train, val, test = parts(spark, sf_dir)
    models = TU.Models(train)
    sides = [(TU.baseline_scorer(train, p, models), p) for p in (val, test)]
    return _final(spark, "baseline", *sides, grid)


def final_eval_read(spark, sf_dir, grid=None):
    """Read-aware variant, tuned on validation and evaluated on the test pairs."""
    train, val, test = parts(spark, sf_dir)
    models = TU.Models(train)
    sides = [(TU.read_scorer(train, p, READ_UNREAD, models), p) for p in (val, test)]
    return _final(spark, "read", *sides, grid)


def final_eval_review(spark, sf_dir, grid=None):
    """Review-blended variant: LR grid, its winner, ALS grid, its winner, test pairs."""
    return _final(spark, "review", *_review_scorers(spark, sf_dir, "review"), grid)


def final_eval_combined(spark, sf_dir, grid=None):
    """Combined variant: reviews, else read model, else unread model, on the test pairs."""
    return _final(spark, "combined", *_review_scorers(spark, sf_dir, "combined"), grid)


QUERIES = {
    "final_eval_read": final_eval_read,
    "eval_grid": eval_grid,
    "best_config": best_config,
    "grid_pivot": grid_pivot,
    "leaderboard": leaderboard,
    "results_append": results_append,
    "results_headerless_scan": results_headerless_scan,
    "grid_als": grid_als,
    "grid_als_read": grid_als_read,
    "grid_lr": grid_lr,
    "grid_review_blend": grid_review_blend,
    "grid_combined": grid_combined,
    "final_eval": final_eval,
    "final_eval_review": final_eval_review,
    "final_eval_combined": final_eval_combined,
}

# -- oracle ---------------------------------------------------------------------

_CFG_ROWS = ", ".join(f"('{v}', {s})" for v in VARIANTS for s in SHIFTS)
_K_ROWS = ", ".join(f"({k})" for k in KS)

_GRID_CTES = {
    "cfg": f"select * from (values {_CFG_ROWS}) t(variant, shift)",
    "ks": f"select * from (values {_K_ROWS}) t(k)",
    "pred": f"""select v.user_id, v.book_id, v.rating, c.variant, cast(c.shift as double) as shift,
                       case when raw - c.shift < 0 then 0.0 else raw - c.shift end as p
                from (select *, prediction as s from val_scored) v
                cross join cfg c
                cross join lateral (select case when c.variant = 'score' then v.s
                                                else {MAX_SCORE} - v.s end as raw) r""",
    "ranked": """select p.*, ks.k,
                        rank() over (partition by ks.k, variant, shift, user_id order by p desc) as rk
                 from pred p cross join ks""",
    "top": """select *, row_number() over (partition by k, variant, shift, user_id
                                           order by rk, book_id) as pos
              from ranked where rk <= k""",
    "truth": "select distinct user_id, book_id from val where rating >= 4",
    "nt": "select user_id, count(*) as nt from truth group by user_id",
    "nh": "select user_id, count(*) as nh from (select distinct user_id, book_id from val) d "
    "group by user_id",
    "hits": """select t.k, t.variant, t.shift, t.user_id, t.pos,
                      row_number() over (partition by t.k, t.variant, t.shift, t.user_id
                                         order by t.pos) as cum
               from top t join truth using (user_id, book_id)""",
    "per_user": """select t.k, t.variant, t.shift, t.user_id, sum((p - rating) * (p - rating)) as se,
                          count(*) as n
                   from top t group by t.k, t.variant, t.shift, t.user_id""",
    "aps": """select k, variant, shift, user_id, sum(cum * 1.0 / pos) as aps
              from hits group by k, variant, shift, user_id""",
    "grid": """select u.variant, '100' as sample, cast(u.k as int) as k, u.shift,
                      sqrt(sum(u.se) / sum(u.n)) as rmse,
                      avg(case when nt.nt is not null then coalesce(a.aps, 0) / nt.nt end) as map,
                      sum(u.n * 1.0 / nh.nh) / (select count(*) from nh) as coverage,
                      cast(sum(u.n) as bigint) as n_rows
               from per_user u
               left join nh using (user_id)
               left join nt using (user_id)
               left join aps a using (k, variant, shift, user_id)
               group by u.variant, u.k, u.shift""",
    "rmse_best": """select variant, sample, rmse as best_rmse, k as rmse_k, shift as rmse_shift
                    from (select *, row_number() over (partition by variant, sample
                                                       order by round(rmse, 9), k, shift) as o
                          from grid) x where o = 1""",
    "map_best": """select variant, sample, map as best_map, k as map_k, shift as map_shift
                   from (select *, row_number() over (partition by variant, sample
                                                      order by -round(map, 9), k, shift) as o
                         from grid) x where o = 1""",
}


def _grid_sql(body: str) -> str:
    return sql_with(body, "val_scored", extra=_GRID_CTES)


def _sweep_sql(body: str) -> str:
    """The grid's CTEs with the sample as one more configuration column."""
    samples = ", ".join(f"('{n}', {_sample_cut(n)})" for n in SAMPLES)
    extra = {
        k: q.replace("variant, shift", "variant, shift, sample").replace(
            "t.variant, t.shift", "t.variant, t.shift, t.sample"
        )
        for k, q in _GRID_CTES.items()
        if k not in ("cfg", "pred", "grid")
    }
    ctes = {
        "cfg": f"""select variant, shift, sample, cut from (values {_CFG_ROWS}) t(variant, shift)
                   cross join (values {samples}) s(sample, cut)""",
        "ks": _GRID_CTES["ks"],
        "pred": _GRID_CTES["pred"].replace("c.variant, cast", "c.variant, c.sample, cast")
        + f" where {_hb("concat('2020s:', v.user_id)")} % {SAMPLE_BUCKETS} < c.cut",
        **{k: extra[k] for k in ("ranked", "top", "truth", "nt", "nh", "hits", "per_user", "aps")},
        "grid": """select u.variant, u.sample, cast(u.k as int) as k, u.shift,
                          sqrt(sum(u.se) / sum(u.n)) as rmse,
                          avg(case when nt.nt is not null then coalesce(a.aps, 0) / nt.nt end) as map
                   from per_user u left join nt using (user_id)
                   left join aps a using (k, variant, shift, sample, user_id)
                   group by u.variant, u.sample, u.k, u.shift""",
        "rmse_best": _GRID_CTES["rmse_best"],
        "map_best": _GRID_CTES["map_best"].replace("from grid) x", "from grid where map is not null) x"),
    }
    return sql_with(body.replace("join map_best", "left join map_best"), "val_scored", extra=ctes)


_BEST = """select variant, sample, round(best_rmse, 6) as best_rmse, rmse_k, rmse_shift,
                  round(best_map, 6) as best_map, map_k, map_shift
           from rmse_best join map_best using (variant, sample)"""

_REV = """select p.user_id, p.book_id, p.is_read from {part} p join reviews r
          on p.user_id = r.user_id and p.book_id = r.book_id and cast(p.rating as float) = r.rating"""


def _warm(part: str, flag: str = "") -> str:
    """Pairs of a part that a model fitted on (a flag's) training rows can score."""
    side = {"": "", "read": "is_read <> 0", "unread": "is_read = 0"}[flag]
    cond, where = (f"and {side}", f"where {side}") if side else ("", "")
    return f"""select user_id, book_id from {part}
               where user_id in (select user_id from train {where})
                 and book_id in (select book_id from train {where}) {cond}"""


def _scored_sql(variant: str, part: str) -> str:
    rev = _REV.format(part=part)
    both = f"{_warm(part, 'read')} union {_warm(part, 'unread')}"
    return {
        "baseline": _warm(part),
        "read": both,
        "review": f"{_warm(part)} union select user_id, book_id from ({rev})",
        "combined": f"{both} union select user_id, book_id from ({rev}) where is_read <> 0",
        "lr": f"select user_id, book_id from ({rev})",
    }[variant]


def _eval_sql(variant: str, part: str, body: str) -> str:
    held = f"select user_id, book_id from ({_REV.format(part=part)})" if variant == "lr" else part
    extra = {
        "pairs": _scored_sql(variant, part),
        "held": f"select user_id, count(*) as nh from (select distinct user_id, book_id from ({held})) group by 1"
        if variant == "lr"
        else f"select user_id, count(*) as nh from {part} group by 1",
        "got": "select user_id, count(*) as n from pairs group by 1",
        "ev": """select cast(coalesce(sum(n), 0) as bigint) as n_rows, count(*) as n_users,
                        round(sum(coalesce(n, 0) * 1.0 / nh) / count(*), 6) as coverage,
                        round(avg(n * 1.0 / nh), 6) as map
                 from held left join got using (user_id)""",
    }
    return sql_with(body, "train", part, "reviews", extra=extra)


def _grid_oracle(variant: str, configs: str, columns: str) -> str:
    body = f"""select '{variant}' as variant, {columns}, n_rows, n_users, coverage, 1 as valid
               from ev cross join (values {configs}) c({columns})"""
    return _eval_sql(variant, "val", body)


_ALS_ROWS = ", ".join(f"({p.max_iter}, {p.rank}, {p.reg}::double)" for p in GRID)
_LR_ROWS = ", ".join(f"(200, 0, {r}::double, {n}::double)" for r in LR_GRID[0] for n in LR_GRID[1])
_ALS_COLUMNS = "max_iter, rank, reg"


def _final_oracle(variant: str) -> str:
    body = f"""select '{variant}' as variant, 'test' as split, n_rows, n_users, coverage, map, 1 as valid
               from ev"""
    return _eval_sql(variant, "test", body)


ORACLE = {
    "grid_als": _grid_oracle("baseline", _ALS_ROWS, _ALS_COLUMNS),
    "grid_als_read": _grid_oracle("read", _ALS_ROWS, _ALS_COLUMNS),
    "grid_review_blend": _grid_oracle("review", _ALS_ROWS, _ALS_COLUMNS),
    "grid_combined": _grid_oracle("combined", _ALS_ROWS, _ALS_COLUMNS),
    "grid_lr": _grid_oracle("lr", _LR_ROWS, _ALS_COLUMNS + ", net"),
    "final_eval": _final_oracle("baseline"),
    "final_eval_read": _final_oracle("read"),
    "final_eval_review": _final_oracle("review"),
    "final_eval_combined": _final_oracle("combined"),
    "eval_grid": _grid_sql(
        """select variant, sample, k, shift, round(rmse, 6) as rmse, round(map, 6) as map,
                  round(coverage, 6) as coverage, n_rows from grid"""
    ),
    "best_config": _grid_sql(_BEST),
    "leaderboard": _sweep_sql(_BEST),
    "grid_pivot": _grid_sql(
        "select variant, sample, k, "
        + ", ".join(
            f"round(max(rmse) filter (where shift = {s}), 6) as shift_{i}"
            for i, s in enumerate(SHIFTS)
        )
        + " from grid group by variant, sample, k"
    ),
    "results_append": _grid_sql(
        """select run, variant, sample, k, shift, round(rmse, 6) as rmse, round(map, 6) as map
           from grid cross join (values (1), (2)) r(run)"""
    ),
    "results_headerless_scan": _grid_sql(
        "select k, shift, round(rmse, 6) as rmse, round(map, 6) as map from grid"
    ),
}
