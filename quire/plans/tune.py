"""Grid search: one generic job parameterised by a scorer (L1-L5), plus the
result sink and winner selection (A5, A6, D10, D11, L7).

The driver hands out configurations (a few dozen at most) and receives one
metrics row per configuration; every fit and evaluation is a distributed job.
The sink is the grid's ledger: it is keyed by configuration, a rerun fits only
what it does not hold, and a retried write replaces its own row.  Several
configurations may run at once, each in a scheduler pool of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import blend as B
from quire.operators import models as MD
from quire.plans.evaluate import evaluate_topk
from quire.session import scratch_path
from quire.sources.schemas import RESULTS, RESULTS_CSV

Scorer = Callable[[MD.ALSParams], DataFrame]


def als_grid(max_iters: Iterable[int], ranks: Iterable[int], regs: Iterable[float]):
    """Configurations in the original nesting order: iteration, rank, reg."""
    return [
        MD.ALSParams(max_iter=i, rank=r, reg=g) for i, r, g in product(max_iters, ranks, regs)
    ]


def grid_search(
    spark: SparkSession,
    configs: list[MD.ALSParams],
    scorer: Scorer,
    heldout: DataFrame,
    variant: str,
    sample: str,
    k: int = 500,
    prediction_col: str = "prediction",
    sink: str | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Evaluate every configuration; returns the results table (RESULTS schema).

    Each configuration's row is committed to ``sink`` (see ``commit_results``) as soon as
    it is known.  Configurations of this variant and sample that the sink
    holds already are not fitted again, so a grid that was stopped goes on where
    it was; ``parallelism`` of them run at a time.
    """
    sink = sink or scratch_path(spark, f"grid-{variant}")

    def job(p: MD.ALSParams) -> None:
        m = evaluate_topk(scorer(p), heldout, k=k, prediction_col=prediction_col).first()
        row = (variant, sample, p.max_iter, p.rank, float(p.reg), *_metrics(m))
        commit_results(spark.createDataFrame([row], RESULTS), sink, RESULT_KEYS)

    rows = [(variant, sample, p.max_iter, p.rank, float(p.reg)) for p in configs]
    run_open(spark, configs, rows, RESULTS, RESULT_KEYS, sink, job, parallelism)
    mine = (F.col("variant") == variant) & (F.col("sample") == sample)
    return read_results(spark, sink, RESULTS).where(mine)


def run_open(spark, configs: list, rows: list[tuple], schema: T.StructType, keys: list[str], sink: str,
             job: Callable, parallelism: int = 1) -> None:
    """Runs ``job`` on the configurations that the ledger ``sink`` lacks, several at a time.

    ``rows``: each configuration's values of ``keys``.  Every job runs in the
    scheduler pool ``grid-<slot>`` (fair sharing where the session's scheduler
    mode is FAIR).  After a failure the running jobs end, no new ones begin, and
    the error is raised.
    """
    wanted = T.StructType([schema[c] for c in keys] + [T.StructField("_at", T.IntegerType())])
    asked = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], wanted)
    done = read_results(spark, sink, schema).select(*keys)
    same = [asked[c].eqNullSafe(done[c]) for c in keys]
    waiting = sorted(r[0] for r in asked.join(done, same, "left_anti").select("_at").collect())
    if parallelism <= 1:
        for i in waiting:
            job(configs[i])
        return
    failed: list[BaseException] = []

    def one(i: int, slot: int) -> None:
        if failed:
            return
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{slot}")
        try:
            job(configs[i])
        except BaseException as e:  # noqa: BLE001
            failed.append(e)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for n, i in enumerate(waiting):
            pool.submit(inheritable_thread_target(spark)(one), i, n % parallelism)
    if failed:
        raise failed[0]


def _metrics(m) -> tuple:
    return (_f(m["rmse"]), _f(m["map"]), _f(m["coverage"]), m["n_rows"], m["n_users"])


def winner(results: DataFrame, base: MD.ALSParams = MD.ALSParams()) -> MD.ALSParams:
    """The configuration of least RMSE of one variant and sample."""
    b = best_config(results).first()
    return MD.with_params(base, max_iter=b["rmse_max_iter"], rank=b["rmse_rank"], reg=b["rmse_reg"])


def tune_and_test(
    spark: SparkSession,
    configs: list[MD.ALSParams],
    val: tuple[Scorer, DataFrame],
    test: tuple[Scorer, DataFrame],
    variant: str,
    sample: str,
    k: int = 500,
    sink: str | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Grid on the validation pairs, winner, evaluation of the winner on the test pairs.

    ``val`` and ``test`` are (scorer, held-out pairs).
    """
    grid = grid_search(spark, configs, val[0], val[1], variant, sample, k, sink=sink, parallelism=parallelism)
    p = winner(grid)
    m = evaluate_topk(test[0](p), test[1], k=k)
    config = [F.lit(p.max_iter).alias("max_iter"), F.lit(p.rank).alias("rank"), F.lit(float(p.reg)).alias("reg")]
    return m.select(F.lit(variant).alias("variant"), F.lit(sample).alias("sample"), *config, *m.columns)


def _f(x):
    return None if x is None else float(x)


def cached(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# -- scorers for the four variants -------------------------------------------


class Models:
    """The ALS models of one training table, each fitted once.

    Shared by the scorers of the validation and the test pairs: the winner is not
    fitted again, nor is the unread model.
    """

    def __init__(self, train: DataFrame):
        self.train, self.fitted = train, {}

    def of(self, rows: str, p: MD.ALSParams):
        """The model with these parameters of ``all``, ``read`` or ``unread`` rows."""
        if (rows, p) not in self.fitted:
            kept = {"all": lambda df: df, "read": B.read_rows, "unread": B.unread_rows}[rows]
            self.fitted[rows, p] = MD.fit_als(kept(self.train), p)
        return self.fitted[rows, p]


def baseline_scorer(train: DataFrame, pairs: DataFrame, models: Models | None = None) -> Scorer:
    """ALS on all training rows."""
    models = models or Models(train)
    return lambda p: MD.score(models.of("all", p), pairs)


def read_scorer(train: DataFrame, pairs: DataFrame, unread_params=MD.UNREAD_PARAMS, models: Models | None = None) -> Scorer:
    """Read model per config + one unread model shared by every config."""
    models = models or Models(train)
    unread_model = models.of("unread", unread_params)
    return lambda p: MD.read_variant(train, pairs, p, unread_model=unread_model, read_model=models.of("read", p))


def review_blend_scorer(
    train: DataFrame, pairs: DataFrame, review_pred: DataFrame, models: Models | None = None
) -> Scorer:
    """Review score where present, else ALS."""
    models = models or Models(train)

    def run(p):
        als = MD.score(models.of("all", p), pairs)
        return B.blend_two(als, review_pred).withColumnRenamed("total_prediction", "prediction")

    return run


def combined_scorer(
    train: DataFrame, pairs: DataFrame, review_pred: DataFrame, unread_params=MD.UNREAD_PARAMS,
    models: Models | None = None,
) -> Scorer:
    """Review, else ALS on read rows, else unread model."""
    models = models or Models(train)
    unread_pred = MD.score(models.of("unread", unread_params), B.unread_rows(pairs))

    def run(p):
        als = MD.score(models.of("read", p), B.read_rows(pairs))
        blended = B.blend_three(als, review_pred, unread_pred)
        return blended.withColumnRenamed("total_prediction", "prediction")

    return run


# -- LR grid (L3) --------------------------------------------------------------


def lr_grid(
    spark: SparkSession,
    train_feats: DataFrame,
    val_feats: DataFrame,
    regs: Iterable[float],
    nets: Iterable[float],
    sample: str,
    k: int = 25,
    max_iter: int = 200,
    sink: str | None = None,
    parallelism: int | None = None,
    models: dict | None = None,
) -> DataFrame:
    """Elastic-net grid: RMSE over all clamped predictions, MAP over top-k
    ranked review pairs vs the user's reviewed held-out pairs.  Resumes and
    runs several points at a time as ``grid_search`` does, as many as the driver
    holds unless ``parallelism`` is given.  ``models`` receives the models fitted
    here by (reg, net)."""
    # a new schema: StructType.add would mutate the shared RESULTS in place
    schema = T.StructType(RESULTS.fields + [T.StructField("net", T.DoubleType())])
    keys = [*RESULT_KEYS, "net"]
    sink = sink or scratch_path(spark, "grid-lr")

    def job(point: tuple[float, float]) -> None:
        reg, net = point
        model = MD.fit_lr(train_feats, reg, net, max_iter=max_iter)
        if models is not None:
            models[point] = model
        pred = cached(MD.review_predictions(model, val_feats))  # read by two actions
        m = evaluate_topk(pred, val_feats, k=k).first()
        err = F.col("prediction") - F.col("rating")
        rmse_all = pred.agg(F.sqrt(F.avg(err * err))).first()[0]
        pred.unpersist()
        metrics = (_f(rmse_all), *_metrics(m)[1:])
        row = ("lr", sample, max_iter, 0, float(reg), *metrics, float(net))
        commit_results(spark.createDataFrame([row], schema), sink, keys)

    points = list(product(regs, nets))
    parallelism = parallelism or MD.fits_at_once(train_feats, len(points))
    rows = [("lr", sample, max_iter, 0, float(reg), float(net)) for reg, net in points]
    run_open(spark, points, rows, schema, keys, sink, job, parallelism)
    return read_results(spark, sink, schema).where(F.col("sample") == sample)


def lr_winner(results: DataFrame) -> tuple[float, float]:
    """(reg, net) of least RMSE: the regression that scores the reviews."""
    b = best_config(results, config=("reg", "net")).first()
    return b["rmse_reg"], b["rmse_net"]


# -- winners and reports --------------------------------------------------------


ALS_CONFIG = ("max_iter", "rank", "reg")
#: decimals at which metrics count as equal
WINNER_DIGITS = 9


def best_config(
    results: DataFrame, keys=("variant", "sample"), config=ALS_CONFIG
) -> DataFrame:
    """Per key group: the min-RMSE and the max-MAP configuration.

    ``min(struct(metric, *config))`` picks the first configuration in grid
    order among equal metrics, the same as a strict ``<`` / ``>`` scan over an
    ascending grid (``max_by`` alone is undefined on ties).  Metrics are compared
    at ``WINNER_DIGITS`` decimals: sums of the same terms in another order differ
    in their last bits.  A configuration whose metric is null or NaN never wins.
    """
    defined = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    at = lambda c: F.round(c, WINNER_DIGITS)
    by_rmse = F.min(F.when(defined("rmse"), F.struct(at("rmse").alias("rmse"), *config)))
    by_map = F.min(F.when(defined("map"), F.struct((-at("map")).alias("neg_map"), *config)))
    agg = results.groupBy(*keys).agg(by_rmse.alias("r"), by_map.alias("m"))
    return agg.select(
        *keys,
        F.col("r.rmse").alias("best_rmse"),
        *[F.col(f"r.{c}").alias(f"rmse_{c}") for c in config],
        (-F.col("m.neg_map")).alias("best_map"),
        *[F.col(f"m.{c}").alias(f"map_{c}") for c in config],
    )


def grid_pivot(
    results: DataFrame,
    values: list,
    metric: str = "rmse",
    rows=("variant", "sample", "max_iter", "reg"),
    pivot: str = "rank",
) -> DataFrame:
    """metric by ``rows`` x ``pivot`` values: the table behind the original plots.

    Pivot values are explicit, so no extra distinct pass runs; columns are
    named ``{pivot}_{i}`` by value position.
    """
    wide = results.groupBy(*rows).pivot(pivot, list(values)).agg(F.first(metric))
    return wide.select(
        *rows, *[F.col(f"`{c}`").alias(f"{pivot}_{i}") for i, c in enumerate(wide.columns[len(rows):])]
    )


def leaderboard(results: DataFrame, keys=("variant", "sample"), config=ALS_CONFIG) -> DataFrame:
    """Variant x sample leaderboard of winners, best RMSE first."""
    return best_config(results, keys, config).orderBy("sample", "best_rmse")


#: what tells the rows of a results table apart
RESULT_KEYS = ["variant", "sample", "max_iter", "rank", "reg"]


def commit_results(results: DataFrame, path: str, keys: list[str]) -> None:
    """Appends rows to a results table (A5); a row replaces an earlier one of the same keys.

    Each key is a partition of its own, and a write replaces the partitions it
    has rows for and no others.  So a retried or repeated append leaves one row
    per key, and appends of different keys may run at the same time.  Rows of one
    append that share a key count once.
    """
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in keys]))
    rest = [c for c in results.columns if c not in keys]
    one = results.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")) if rest else results.distinct()
    flat = one.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in results.columns], key.alias("_key"))
    flat.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_key").parquet(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows committed so far; none where nothing was written yet."""
    keyed = T.StructType(schema.fields + [T.StructField("_key", T.StringType())])
    try:
        return spark.read.schema(keyed).parquet(path).drop("_key")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_results_csv(results: DataFrame, path: str) -> None:
    """Headerless CSV in the original ``iter,rank,reg,rmse,map`` layout."""
    results.select(
        *[F.col(f.name).cast("double") for f in RESULTS_CSV.fields]
    ).write.mode("append").option("header", False).csv(path)


def read_results_csv(spark: SparkSession, path: str, variant: str, sample: str) -> DataFrame:
    """Headerless result files read with named columns."""
    raw = spark.read.schema(RESULTS_CSV).option("header", False).csv(path)
    return raw.select(
        F.lit(variant).alias("variant"),
        F.lit(sample).alias("sample"),
        F.col("max_iter").cast("int").alias("max_iter"),
        F.col("rank").cast("int").alias("rank"),
        "reg",
        "rmse",
        "map",
    )
