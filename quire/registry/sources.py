"""A: scans and sinks, each as a round trip through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.functions.columns import typed_interactions
from quire.operators import split as S
from quire.registry.common import interactions, r6, sql_with
from quire.session import scratch_path
from quire.sources import fixtures as FX
from quire.sources import io as IO


def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "interactions-csv")
    IO.write_csv(IO.as_strings(interactions(spark, sf_dir)), path)
    return typed_interactions(IO.read_csv(spark, path))


def json_scan(spark, sf_dir):
    path = scratch_path(spark, "reviews-json")
    FX.raw_reviews(spark, sf_dir).write.mode("overwrite").json(path)
    return IO.read_json(spark, path)


def parquet_scan(spark, sf_dir):
    """Pruned, filtered scan: only three columns are read, the filter is pushed."""
    lines = IO.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.where(F.col("l_returnflag") != "N").select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "split-parquet")
    IO.write_parquet(S.split_table(interactions(spark, sf_dir)), path, partition_by="part")
    return spark.read.parquet(path)


def temp_view_query(spark, sf_dir):
    name = IO.register_view(interactions(spark, sf_dir), f"interactions_{uuid.uuid4().hex[:8]}")
    out = spark.sql(
        f"select is_read, count(*) as n, avg(rating) as mean_rating from {name} group by is_read"
    )
    return out.select("is_read", "n", r6("mean_rating"))


def csv_to_parquet(spark, sf_dir):
    csv_path = scratch_path(spark, "raw-csv")
    IO.write_csv(IO.as_strings(interactions(spark, sf_dir)), csv_path)
    return IO.csv_to_parquet(spark, csv_path, scratch_path(spark, "typed-parquet"))


QUERIES = {
    "csv_scan": csv_scan,
    "json_scan": json_scan,
    "parquet_scan": parquet_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "temp_view_query": temp_view_query,
    "csv_to_parquet": csv_to_parquet,
}

_TYPED = """select user_id, book_id, is_read, cast(rating as float) as rating, is_reviewed
            from interactions"""

ORACLE = {
    "csv_scan": sql_with(_TYPED, "interactions"),
    "json_scan": sql_with(
        """select md5('u' || cast(user_id as varchar)) as user_id,
                  md5('b' || cast(book_id as varchar)) as book_id,
                  cast(rating as double) as rating, review_text, review_id
           from reviews""",
        "reviews",
    ),
    "parquet_scan": """select l_orderkey, l_partkey, l_quantity from lineitem
                       where l_returnflag <> 'N'""",
    "parquet_roundtrip": sql_with(
        """select *, 'train' as part from train
           union all select *, 'val' as part from val
           union all select *, 'test' as part from test""",
        "train",
        "val",
        "test",
    ),
    "temp_view_query": sql_with(
        """select is_read, count(*) as n, round(avg(rating), 6) as mean_rating
           from interactions group by is_read""",
        "interactions",
    ),
    "csv_to_parquet": sql_with(_TYPED, "interactions"),
}
