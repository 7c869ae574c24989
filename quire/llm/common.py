"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import scratch_path

#: ASCII white space of the word rules: space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A projection that uses an alias several times may be collapsed so that the
    aliased expression runs once per use (inside a lambda: once per element);
    binding it as a lambda variable rules that out.
    """
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: later stages survive lost executors without recomputing
    what went before, and every later use reads the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, total: int, per_partition: int) -> int:
    """Partitions so that each holds about ``per_partition`` of ``total``; the session's count at least."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // max(1, per_partition)))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Total UTF-8 bytes of a text column: one aggregate row, used to size partitions."""
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def persisted(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)
