"""The minimum end-to-end slice.

interactions -> hash split (written once to the shared folder) -> ALS fit
(seeded) -> score held-out pairs (cold start dropped) -> top-500 per user ->
RMSE + MAP + coverage in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import models as MD
from quire.plans.evaluate import evaluate_topk
from quire.plans.prepare import materialize_split
from quire.sources import fixtures as FX

FLAGSHIP_PARAMS = MD.ALSParams(max_iter=5, rank=10, reg=0.1)


def flagship(
    spark: SparkSession, sf_dir: str, params: MD.ALSParams = FLAGSHIP_PARAMS, k: int = 500
) -> DataFrame:
    train, val, _ = materialize_split(spark, FX.interactions(spark, sf_dir))
    model = MD.fit_als(train, params)
    pred = MD.score(model, val)
    metrics = evaluate_topk(pred, val, k=k)
    return metrics.select(
        F.lit("als").alias("variant"),
        F.lit(params.max_iter).alias("max_iter"),
        F.lit(params.rank).alias("rank"),
        F.lit(float(params.reg)).alias("reg"),
        "rmse",
        "map",
        "coverage",
        "n_rows",
        "n_map_users",
        "n_users",
    )
