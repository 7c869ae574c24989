"""Micro-goldens (FIXTURES.md section 4): hand-sized inputs with known answers."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from quire.functions.text import ENGLISH_STOP_WORDS, clean_text, remove_stop_words, tokenize
from quire.operators import blend as B
from quire.operators import metrics as M
from quire.operators import ranking as R
from quire.operators import text as T


def _pred(spark, user, items):
    return spark.createDataFrame(
        [(user, b, i + 1) for i, b in enumerate(items)], "user_id int, book_id int, row_num int"
    )


def _truth(spark, user, items):
    return spark.createDataFrame([(user, b) for b in items], "user_id int, book_id int")


def test_ranking_metrics_example(spark):
    p, t = _pred(spark, 1, [1, 9, 2]), _truth(spark, 1, [1, 2, 3])
    per = M.per_user_ranking(p, t, k=2).first()
    assert per.ap == pytest.approx(0.5555555556, abs=1e-9)
    assert per.precision_at_k == pytest.approx(0.5)
    assert per.recall_at_k == pytest.approx(1 / 3)
    assert per.ap_at_k == pytest.approx(0.5)
    ndcg3 = M.per_user_ranking(p, t, k=3).first().ndcg_at_k
    assert ndcg3 == pytest.approx(0.7039180890, abs=1e-9)


def test_ap_half(spark):
    row = M.mean_average_precision(_pred(spark, 1, [1, 2]), _truth(spark, 1, [1, 2, 3, 4])).first()
    assert row.map == pytest.approx(0.5)


def test_map_two_users_one_without_hits(spark):
    p = _pred(spark, 1, [1, 2]).unionByName(_pred(spark, 2, [7]))
    t = _truth(spark, 1, [1, 2]).unionByName(_truth(spark, 2, [8]))
    assert M.mean_average_precision(p, t).first().map == pytest.approx(0.5)


def test_matches_mllib_ranking_metrics(spark):
    from pyspark.mllib.evaluation import RankingMetrics

    lists = [([1, 9, 2, 7], [1, 2, 3]), ([4, 5], [5]), ([6, 8, 3], [3, 6, 10, 11])]
    preds = None
    truths = None
    for u, (p, t) in enumerate(lists):
        preds = _pred(spark, u, p) if preds is None else preds.unionByName(_pred(spark, u, p))
        truths = _truth(spark, u, t) if truths is None else truths.unionByName(_truth(spark, u, t))
    rm = RankingMetrics(spark.sparkContext.parallelize(lists))
    got = M.ranking_metrics(preds, truths, k=2).first()
    assert got.map == pytest.approx(rm.meanAveragePrecision, abs=1e-12)
    assert got.precision_at_k == pytest.approx(rm.precisionAt(2), abs=1e-12)
    assert got.ndcg_at_k == pytest.approx(rm.ndcgAt(2), abs=1e-12)
    assert got.map_at_k == pytest.approx(rm.meanAveragePrecisionAt(2), abs=1e-12)
    assert got.recall_at_k == pytest.approx(rm.recallAt(2), abs=1e-12)


def test_rank_ties_vs_row_number(spark):
    df = spark.createDataFrame(
        [(1, 10, 3.0), (1, 11, 2.0), (1, 12, 2.0), (1, 13, 1.0)],
        "user_id int, book_id int, prediction double",
    )
    assert R.top_k(df, 2, method="rank").count() == 3
    assert R.top_k(df, 2, method="row_number").count() == 2


def test_rank_by_value_equals_sql_rank(spark):
    df = spark.createDataFrame(
        [(1, i, float(r)) for i, r in enumerate([5, 3, 5, 1, 3, 3, 0])] + [(2, 9, 4.0)],
        "user_id int, book_id int, rating double",
    )
    got = {r.book_id: r.true_row for r in R.rank_by_value(df).collect()}
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc())
    want = {r.book_id: r.rk for r in df.withColumn("rk", F.rank().over(w)).collect()}
    assert got == want


def test_row_number_by_hash_equals_window(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).cast("int").alias("g"),
        F.col("id").cast("int").alias("item"),
        (F.xxhash64("id") % (1 << 31)).alias("h"),
    ).withColumn("h", F.abs("h"))
    got = R.row_number_by_hash(df, "g", "h", "item", hash_bits=31)
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("h", "item")
    want = df.withColumn("row_num", F.row_number().over(w))
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 3000


def test_clean_tokenize_stop_words(spark):
    df = spark.createDataFrame(
        [("Hello,  World! it's  A-b (x) & y. ",), ("",), ("   ",)], "t string"
    )
    rows = df.select(remove_stop_words(tokenize(clean_text("t"))).alias("w")).collect()
    assert rows[0].w == ["hello", "", "world", "", "a-b", "x", "", "y"]
    assert rows[1].w == [""]
    assert rows[2].w == []


def test_tokenize_matches_ml_tokenizer(spark):
    texts = ["a b", "  lead", "trail  ", "x\ty\nz", "", " ", "Mixed CASE  words\x0bvt"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ml = StopWordsRemover(inputCol="tok", outputCol="sw").transform(
        Tokenizer(inputCol="t", outputCol="tok").transform(df)
    )
    ours = ml.select("tok", "sw", tokenize("t").alias("mine"))
    ours = ours.select("tok", "sw", "mine", remove_stop_words("mine").alias("mine_sw")).collect()
    for r in ours:
        assert r.mine == r.tok
        assert r.mine_sw == r.sw


def test_stop_word_list_is_sparks():
    assert list(StopWordsRemover.loadDefaultStopWords("english")) == ENGLISH_STOP_WORDS


def test_idf_values(spark):
    docs = spark.createDataFrame(
        [(1, "apple banana"), (2, "apple cherry"), (3, "date")], "doc_id int, text string"
    )
    idf = {r.term: r.tfidf for r in T.tfidf_long(docs).collect()}
    assert idf["apple"] == pytest.approx(math.log(4 / 3), abs=1e-10)  # 0.2876820725
    assert idf["banana"] == pytest.approx(math.log(4 / 2), abs=1e-10)  # 0.6931471806


def test_nan_drop_and_subtract(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, 5.0), (1, 1, 0, 5.0), (1, 2, 1, 4.0), (1, 3, 1, None)],
        "user_id int, book_id int, is_read int, rating double",
    )
    kept = B.nan_drop_read(df).collect()
    assert [(r.book_id, r.rating) for r in kept] == [(2, 4.0)]
    rest = sorted((r.book_id, r.rating) for r in B.unread_except(df).collect())
    assert rest == [(1, 5.0), (3, None)]


def test_clamp_keeps_nulls(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "prediction double")
    vals = [r.prediction for r in B.clamp_predictions(df).collect()]
    assert vals == [0.0, 2.0, None]


def test_rank_by_value_keeps_null_values(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0), (1, 2, None), (1, 3, 3.0), (1, 4, None)],
        "user_id int, book_id int, rating double",
    )
    got = {r.book_id: r.true_row for r in R.rank_by_value(df).collect()}
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc())
    want = {r.book_id: r.rk for r in df.withColumn("rk", F.rank().over(w)).collect()}
    assert got == want
    sizes = {r.book_id: r.running_size for r in R.running_count(df).collect()}
    assert sizes == {1: 1, 3: 2, 2: 4, 4: 4}


def test_tokenize_drop_empty(spark):
    df = spark.createDataFrame([("a  b ",)], "t string")
    assert df.select(tokenize("t", drop_empty=True).alias("w")).first().w == ["a", "b"]


def test_held_out_except_all_keeps_duplicates(spark):
    from quire.operators import split as S

    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert sorted(r.x for r in S.held_out_except(a, b).collect()) == [1]
    assert sorted(r.x for r in S.held_out_except(a, b, keep_all=True).collect()) == [1, 1]
