"""Fixture views over the driver's read-only tables.

The reference consumes a user-book interaction table, id maps and review text.
Here they are *derived by Spark* from the given star schema so that every query
grows with the data: customers are users, parts are books, a line item is an
interaction, and review text comes from ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.columns import hash_bucket
from quire.session import CODEC, scratch_path, shuffles_for, spread

# (application id, sf_dir, table) -> staged Parquet path in the shared folder
_STAGED: dict[tuple[str, str, str], str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_wide(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    """Pruned scan of a fact table feeding CPU-heavy work, spread over the cluster."""
    return spread(load(spark, sf_dir, name).select(*columns))


def staged(spark: SparkSession, sf_dir: str, name: str, build,
           partition_by: str | None = None) -> DataFrame:
    """Derive a fixture table once per application and read it back from Parquet.

    The original study converts its raw interactions to Parquet once and reads
    that table everywhere; this does the same for derived fixtures.  The table
    lives in the shared folder (``spark.checkpoint.dir``), so it also cuts
    lineage: a lost executor re-reads files instead of re-running the join.
    """

    def write(path: str) -> None:
        df = build(spark, sf_dir)
        # every derived table has at most a row per line item
        with shuffles_for(spark, load(spark, sf_dir, "lineitem").count()):
            writer = df.write.mode("overwrite").option("compression", CODEC)
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)

    return spark.read.parquet(staged_path(spark, sf_dir, name, write))


def staged_path(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Where a table of this application is staged; ``write(path)`` makes it the first time."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, f"fixture-{name}")
        write(path)
        _STAGED[key] = path
    return path


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id int, book_id int, is_read int, rating double, is_reviewed int).

    One row per (customer, part) pair: read if any line was returned or
    flagged, rating 1..5 from the largest quantity when read, 0 when unread.
    Staged once per application (see ``staged``).
    """
    return staged(spark, sf_dir, "interactions", derive_interactions)


def derive_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interactions derivation itself: lineitem x orders, aggregated per pair."""
    lines = load_wide(
        spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag", "l_quantity"]
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(
            F.col("o_custkey").cast("int").alias("user_id"),
            F.col("l_partkey").cast("int").alias("book_id"),
        )
        .agg(
            F.max(F.when(F.col("l_returnflag") != "N", 1).otherwise(0))
            .cast("int")
            .alias("is_read"),
            F.max("l_quantity").alias("q"),
        )
    )
    rating = (
        F.when(F.col("is_read") == 0, F.lit(0))
        .otherwise(1 + F.floor((F.col("q") - 1) / 10))
        .cast("double")
    )
    reviewed = (
        F.when(hash_bucket("rev", "user_id", "book_id") % 20 == 0, 1)
        .otherwise(0)
        .cast("int")
    )
    return pairs.select(
        "user_id", "book_id", "is_read", rating.alias("rating"), reviewed.alias("is_reviewed")
    )


def score() -> Column:
    """Deterministic stand-in prediction in [0, 4.995] for ranking / metric checks."""
    raw = (F.col("user_id").cast("bigint") * 7919 + F.col("book_id").cast("bigint") * 104729) % 1000
    return (raw.cast("double") / 200).alias("score")


def user_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id_csv int, user_id string): numeric id <-> opaque string id."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id_csv"),
        F.md5(F.concat(F.lit("u"), F.col("c_custkey").cast("string"))).alias("user_id"),
    )


def book_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id_csv int, book_id string)."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("book_id_csv"),
        F.md5(F.concat(F.lit("b"), F.col("p_partkey").cast("string"))).alias("book_id"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reviews: one per reviewed interaction, text taken from ``documents``.

    Staged once per application (see ``staged``).
    """
    return staged(spark, sf_dir, "reviews", derive_reviews)


def derive_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = interactions(spark, sf_dir)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    n_docs = docs.select(F.count("*")).scalar()
    docs = spread(docs)
    reviewed = inter.where(F.col("is_reviewed") == 1).select(
        "user_id",
        "book_id",
        "rating",
        (hash_bucket("doc", "user_id", "book_id") % n_docs).alias("doc_id"),
    )
    return reviewed.join(docs, "doc_id").select(
        "user_id",
        "book_id",
        F.col("rating").cast("float").alias("rating"),
        F.col("text").alias("review_text"),
        F.concat_ws(":", F.col("user_id").cast("string"), F.col("book_id").cast("string")).alias(
            "review_id"
        ),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews keyed by the opaque string ids, as a review dump delivers them."""
    return reviews(spark, sf_dir).select(
        F.md5(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user_id"),
        F.md5(F.concat(F.lit("b"), F.col("book_id").cast("string"))).alias("book_id"),
        F.col("rating").cast("double").alias("rating"),
        "review_text",
        "review_id",
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) over the whole documents table."""
    return load_wide(spark, sf_dir, "documents", ["doc_id", "text"])
