"""A corpus pipeline of five operators; each stage works on all its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of documents.  Every
stage is written as Parquet in the shared folder and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import minhash_dedup, quality_rules, sentence_pieces, source_mix, suffix_dedup
from quire.llm.common import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that are above the limit of documents.

    Null and empty texts have no words and are rejected; a null source is a host of its own; rows without an
    id are documents that are never the first holder of a line; repeated rows count as one document and get
    one verdict; texts of any length are judged whole; an empty table stays empty; all columns are carried
    along, whatever their names.
    """
    return quality_rules.apply_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity of 0.8 or more).

    The row of the smallest id stays; of rows that agree in id and text one; rows without an id all stay, and
    so do null and wordless texts, which are like nothing.  Texts that share an id are decided each by itself.
    Texts of any length are compared whole; an empty table stays empty; all columns are carried along.
    """
    return minhash_dedup.drop_near_duplicates(docs, minhash_dedup.NearDupParams(percent=80, bands=40, rows=5))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has.

    Null texts stay null and empty ones empty; rows with one id never lose bytes to each other, rows without
    an id to none; of equal passages the one in the smallest id stays; texts of any length are cut whole; an
    empty table stays empty; all columns are carried along.
    """
    return suffix_dedup.drop_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, repeats included.

    Documents without a taken word go, null and empty ones among them; a null source is a source of its own,
    last in order; repeated rows and rows without an id are documents each; texts of any length are cut at
    blocks; an empty table stays empty; all columns are carried along, ``n_chars`` follows the text.
    """
    return source_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix.

    Null and empty texts have no ids; every row is encoded by itself, also where rows repeat or have no id;
    texts of any length are encoded whole; an empty table gives an empty result; other columns are not kept.
    """
    return sentence_pieces.encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_dedup),
    ("repeated_passages", repeated_passages),
    ("source_mix", mixed_sources),
    ("sentence_pieces", tokens),
]

#: DuckDB SQL can express neither the word cuts of the mix nor the token ids; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
