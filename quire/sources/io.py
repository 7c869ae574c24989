"""Readers and writers with explicit schemas.

Paths for staged tables come from ``quire.session.scratch_path`` (the
cluster's shared ``spark.checkpoint.dir``), never a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.columns import typed_interactions
from quire.sources import schemas


def read_csv(spark: SparkSession, path: str, schema=schemas.INTERACTIONS_RAW,
             header: bool = True) -> DataFrame:
    """CSV with header and an explicit schema: no inference pass (A1)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_json(spark: SparkSession, path: str, schema=schemas.RAW_REVIEWS) -> DataFrame:
    """JSON lines with an explicit schema (A2)."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet; selecting columns here lets Catalyst prune the scan (A3)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink, optionally partitioned by a low-cardinality column (A4)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """Raw string CSV -> typed interactions -> Parquet, read back."""
    typed = typed_interactions(read_csv(spark, csv_path))
    write_parquet(typed, parquet_path)
    return spark.read.parquet(parquet_path)


def register_view(df: DataFrame, name: str) -> str:
    """Temp view for SQL access."""
    df.createOrReplaceTempView(name)
    return name


def as_strings(df: DataFrame) -> DataFrame:
    """All columns as strings, the shape a header CSV delivers."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
