"""Materialise the split once, as the original study does with its Parquet files.

The split table is written partitioned by ``part`` into the cluster's shared
folder (``spark.checkpoint.dir``).  Model jobs then read pruned partitions:
the raw join / aggregate / hashing runs once, lineage is cut (a lost executor
re-reads files instead of recomputing the derivation), and every later scan
gets partition pruning plus pushed filters on typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import split as S
from quire.session import scratch_path


def materialize_split(
    spark: SparkSession,
    interactions: DataFrame,
    spec: S.SplitSpec = S.DEFAULT_SPLIT,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the split table once; return (train, val, test) read back from it."""
    path = path or scratch_path(spark, "split")
    S.split_table(interactions, spec).write.mode("overwrite").partitionBy("part").parquet(path)
    table = spark.read.parquet(path)
    cols = [c for c in interactions.columns]
    return tuple(
        table.where(F.col("part") == p).select(*cols) for p in ("train", "val", "test")
    )
