"""Rating models: Spark ML's ALS and elastic-net LinearRegression as jobs.

The estimators are Spark's own (block-partitioned ALS, L-BFGS / OWL-QN /
normal-equation regression); this module fixes their parameters, seeds and
column contracts, and composes them into the read-aware, review-blended and
combined variants.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import blend as B
from quire.operators.factors import item_factors, user_factors
from quire.operators.recommend import top_items
from quire.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ALSParams:
    max_iter: int = 5
    rank: int = 10
    reg: float = 0.1
    nonnegative: bool = True
    seed: int = 2020
    cold_start: str = "drop"
    implicit: bool = False
    alpha: float = 1.0
    checkpoint_interval: int = 10
    #: user and item blocks, the tasks of a half-iteration.  Spark seeds the factors per
    #: block, so the fitted model depends on it: it is a parameter that is kept with the
    #: model, not the cluster's size (10 is Spark's default; see ``sized_for``)
    blocks: int = 10

    def sized_for(self, n_ratings: int, per_block: int = 2_000_000) -> ALSParams:
        """With as many blocks as the ratings need, ``per_block`` of them in each, 10 at least.

        Depends on the data's size alone: the same on any cluster.
        """
        return replace(self, blocks=max(10, -(-n_ratings // per_block)))


UNREAD_PARAMS = ALSParams(max_iter=5, rank=10, reg=0.0)


def als_estimator(
    spark,
    params: ALSParams = ALSParams(),
    user_col: str = "user_id",
    item_col: str = "book_id",
    rating_col: str = "rating",
) -> ALS:
    """The ALS estimator with a fixed seed and a fixed number of blocks.

    A checkpoint directory is ensured (the cluster's ``spark.checkpoint.dir``)
    so long iteration lineages are cut and survive executor loss.
    """
    ensure_checkpoint_dir(spark)
    return ALS(
        maxIter=params.max_iter,
        rank=params.rank,
        regParam=params.reg,
        nonnegative=params.nonnegative,
        seed=params.seed,
        coldStartStrategy=params.cold_start,
        implicitPrefs=params.implicit,
        alpha=params.alpha,
        checkpointInterval=params.checkpoint_interval,
        numUserBlocks=params.blocks,
        numItemBlocks=params.blocks,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
    )


def fit_als(train: DataFrame, params: ALSParams = ALSParams(), **cols) -> ALSModel:
    """Fit ALS on (user, item, rating)."""
    keep = [cols.get("user_col", "user_id"), cols.get("item_col", "book_id"),
            cols.get("rating_col", "rating")]
    return als_estimator(train.sparkSession, params, **cols).fit(train.select(*keep))


def score(model: ALSModel, pairs: DataFrame, out: str = "prediction") -> DataFrame:
    """Score known pairs; cold users/items are dropped by the model."""
    pred = model.transform(pairs)
    return pred if out == "prediction" else pred.withColumnRenamed("prediction", out)


def save_als(model: ALSModel, params: ALSParams, path: str) -> None:
    """The model and the parameters it was fitted with."""
    spark = model.userFactors.sparkSession
    model.write().overwrite().save(f"{path}/model")
    row = spark.createDataFrame([tuple(asdict(params).values())], _params_schema())
    row.write.mode("overwrite").parquet(f"{path}/params")


def load_als(spark, path: str) -> tuple[ALSModel, ALSParams]:
    """What ``save_als`` wrote."""
    row = spark.read.schema(_params_schema()).parquet(f"{path}/params").first()
    return ALSModel.load(f"{path}/model"), ALSParams(**row.asDict())


def _params_schema() -> str:
    kinds = {"int": "int", "float": "double", "bool": "boolean", "str": "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in fields(ALSParams))


def scorable_pairs(pairs: DataFrame, train: DataFrame,
                   user_col: str = "user_id", item_col: str = "book_id") -> DataFrame:
    """The pairs a model fitted on ``train`` can score: user and item both seen."""
    return pairs.join(train.select(user_col).distinct(), user_col, "left_semi").join(
        train.select(item_col).distinct(), item_col, "left_semi"
    )


def read_variant(
    train: DataFrame,
    pairs: DataFrame,
    params: ALSParams = ALSParams(),
    unread_params: ALSParams = UNREAD_PARAMS,
    unread_model: ALSModel | None = None,
    read_model: ALSModel | None = None,
) -> DataFrame:
    """Read model on read rows + unread model on unread rows, unioned.

    Each held-out pair is routed by its own ``is_read`` flag, as the original
    evaluation does; report RMSE per flag (``metrics.rmse_by_flag``) because
    unread pairs are near zero error by construction.
    """
    read_model = read_model or fit_als(B.read_rows(train), params)
    unread_model = unread_model or fit_als(B.unread_rows(train), unread_params)
    cols = pairs.columns + ["prediction"]
    read_pred = score(read_model, B.read_rows(pairs)).select(*cols)
    unread_pred = score(unread_model, B.unread_rows(pairs)).select(*cols)
    return B.union_predictions(read_pred, unread_pred)


def recommend_top_k(model: ALSModel, users: DataFrame, k: int,
                    user_col: str = "user_id", item_col: str = "book_id",
                    seen: DataFrame | None = None) -> DataFrame:
    """Top-k items over the whole catalogue for the given users (J9), in long form.

    (user, item, pos, prediction).  ``seen`` (user, item) pairs are left out inside the
    search (see ``recommend``): a user's history takes up no places of the own
    list and does not lengthen anyone else's.
    """
    asked = user_factors(model, user_col).join(users.select(user_col).distinct(), user_col, "left_semi")
    return top_items(asked, item_factors(model, item_col), k, user_col, item_col, seen)


#: rows of a task in a pass of the regression
LR_ROWS = 100_000


def fit_lr(train: DataFrame, reg: float, net: float, max_iter: int = 200,
           features_col: str = "idf_features", label_col: str = "rating",
           solver: str = "auto") -> LinearRegressionModel:
    """Elastic-net linear regression.

    The estimator keeps its rows itself, packed, so the input is not persisted: it is
    read to count, to standardise, to pack, and for the summary.  Every task of every pass
    sends a gradient as long as the vocabulary, so the passes run over merged partitions:
    as many as there are cores, more only for more than ``LR_ROWS`` rows in each.
    """
    lr = LinearRegression(
        featuresCol=features_col, labelCol=label_col, regParam=reg,
        elasticNetParam=net, maxIter=max_iter, solver=solver,
    )
    data = train.select(features_col, label_col)
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-data.count() // LR_ROWS))
    return lr.fit(data.coalesce(tasks))


#: vectors as long as the vocabulary that a fit keeps on the driver: ten steps, their gradients, and what a step needs
LR_VECTORS = 32


def fits_at_once(train: DataFrame, wanted: int, features_col: str = "idf_features") -> int:
    """How many of ``wanted`` regressions may run at a time, by what the driver's heap holds; 1 at least.

    A pass leaves the cores idle while coefficients are sent out and gradients are added
    up, which another fit's pass can use.
    """
    if wanted < 2 or (first := train.select(features_col).first()) is None or first[0] is None:
        return 1
    heap = train.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return max(1, min(wanted, int(0.7 * heap / (LR_VECTORS * 8 * max(first[0].size, 1)))))


def review_predictions(model: LinearRegressionModel, features: DataFrame) -> DataFrame:
    """LR predictions on review features, clamped at 0."""
    return B.clamp_predictions(model.transform(features))


def with_params(params: ALSParams, **kw) -> ALSParams:
    return replace(params, **kw)
