"""Cleaning, labels, splits and statistics on edge cases."""

import statistics

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import cleaning, labels, splits, stats
from reviewlens.operators.keywords import top_keywords, vocab_document_freq
from reviewlens.operators.ranking import top_k_per_group


def test_clean_reviews(spark):
    rows = [(" a", "4"), ("a", "4"), ("a", "4"), ("  ", "5"), ("b", "abc"), (None, "3"), ("c", None), ("\n", "2")]
    df = spark.createDataFrame(rows, "Review string, Rating string")
    got = sorted(tuple(r) for r in cleaning.clean_reviews(df).collect())
    assert got == [("\n", 2.0), ("a", 4.0), ("a", 4.0)]
    counts = stats.row_counts(df).first().asDict()
    assert counts["raw"] == 8 and counts["present"] == 6 and counts["distinct"] == 5 and counts["clean"] == 3
    assert counts["train"] + counts["test"] == 3 and counts["with_words"] == 2


def test_empty_and_null_input(spark):
    empty = spark.createDataFrame([], "Review string, Rating string")
    nulls = spark.createDataFrame([(None, None)] * 3, "Review string, Rating string")
    for df, raw in ((empty, 0), (nulls, 3)):
        assert cleaning.clean_reviews(df).count() == 0
        assert stats.row_counts(df).first()["raw"] == raw
    labelled = labels.label_from_rating(cleaning.cast_rating(empty))
    assert stats.class_share(labelled).first()["share_percent"] == 0.0
    assert [r["n"] for r in stats.class_counts(labelled, classes=["negative", "positive"]).collect()] == [0, 0]
    assert top_keywords(labelled).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([(3.0, " Positive "), (2.9, "NEGATIVE"), (5.0, "so so"), (1.0, None)], "Rating double, s string")
    assert [r["Sentiment"] for r in labels.label_from_rating(df).collect()] == ["positive", "negative", "positive", "negative"]
    assert labels.label_from_rating(df, three_as_positive=False).first()["Sentiment"] == "negative"
    codes = df.select(labels.sentiment_code(F.col("s")).alias("a"), labels.sentiment_code(F.col("s"), 0.0).alias("b"))
    assert [tuple(r) for r in codes.collect()] == [(1.0, 0.0), (0.0, 1.0), (None, None), (None, None)]
    assert [r[0] for r in df.select(labels.binary_label(F.trim(F.lower("s")))).collect()] == [1, 0, 0, 0]


def test_label_index(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    model = labels.fit_label_index(train, "s")
    assert list(model.labels) == ["c", "a", "b"]
    seen = model.transform(spark.createDataFrame([("a",), ("new",)], "s string"))
    assert [tuple(r) for r in seen.collect()] == [("a", 1.0)]


def test_known_split_key(spark):
    df = spark.createDataFrame([("good", 4.0)], "Review string, Rating double")
    row = splits.stable_split(df).first()
    assert (row["split_key"], row["split"]) == (75, "train")  # hash('good', 4.0) = -2113576875


@pytest.mark.parametrize("method", ["murmur3", "md5"])
def test_stable_split(spark, method):
    df = spark.range(2000).select(F.concat(F.lit("r"), "id").alias("Review"), (F.col("id") % 5).cast("double").alias("Rating"))
    first = splits.stable_split(df, method=method)
    again = splits.stable_split(df.repartition(7).orderBy(F.rand(1)), method=method)
    assert sorted(first.collect()) == sorted(again.collect())
    train, test = splits.part(first, "train"), splits.part(first, "test")
    assert train.intersect(test).count() == 0 and splits.concat_splits(train, test).count() == 2000
    assert 0.76 < train.count() / 2000 < 0.84


def test_random_split(spark):
    df = spark.range(5000)
    parts = {r["part"]: r["count"] for r in splits.random_split(df, (2, 1, 1), 7).groupBy("part").count().collect()}
    assert set(parts) == {0, 1, 2} and abs(parts[0] - 2500) < 150
    one, two = splits.random_split(df, seed=1), splits.random_split(df.repartition(5), seed=1)
    assert sorted(one.collect()) == sorted(two.collect())


def test_word_stats(spark):
    words = [1, 1, 2, 5, 9, 10, None]
    df = spark.createDataFrame([(w,) for w in words], "words int")
    known = [w for w in words if w is not None]
    row = stats.word_count_stats_exact(df).first()
    assert row["median"] == statistics.median(known) == 3.5
    assert row["mean"] == round(statistics.mean(known), 2)
    assert row["variance"] == round(statistics.variance(known), 2)
    assert row["std"] == round(statistics.stdev(known), 2)
    assert stats.word_count_stats(df).first()["median"] in known


def test_class_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2 + [(None,)], "label double")
    weights = {r["label"]: r["weight"] for r in stats.class_weights(df).collect()}
    assert weights == {0.0: 8 / 12, 1.0: 2.0}
    added = stats.add_class_weights(df)
    assert {r["label"]: r["classWeight"] for r in added.collect()} == {**weights, None: None}
    many = stats.add_class_weights(spark.range(1500), "id")
    assert many.count() == 1500 and many.filter("classWeight != 1").count() == 0


def test_hot_groups_are_ranked_exactly(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.xxhash64("id").alias("v"),
    )
    got = top_k_per_group(df, ["g"], [F.asc("v")], 1500)
    assert "_salt" not in got.columns
    expected = sorted(r["v"] for r in df.filter("g = 'hot'").collect())[:1500]
    assert [r["v"] for r in got.filter("g = 'hot'").orderBy("rank").collect()] == expected


def test_keywords(spark):
    rows = [("Great rock rock positive abc", "positive"), ("rock bad bad ab", "negative"), ("tie one two", "negative")]
    df = spark.createDataFrame(rows, "Review string, Sentiment string")
    got = [(r["label"], r["word"], r["value"], r["rank"]) for r in top_keywords(df, k=2).orderBy("label", "rank").collect()]
    assert got == [("negative", "bad", 2, 1), ("negative", "rock", 1, 2), ("positive", "rock", 2, 1), ("positive", "abc", 1, 2)]


def test_vocabulary(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["b", "c"],), ([],), (None,)], "t array<string>")
    assert [tuple(r) for r in vocab_document_freq(df, "t").collect()] == [("b", 2, 2)]
    with_rows = vocab_document_freq(df, "t", min_df=1, vocab_size=2, with_rows=True).collect()
    assert [tuple(r) for r in with_rows] == [(None, 0, 4), ("a", 2, 1), ("b", 2, 2)]
