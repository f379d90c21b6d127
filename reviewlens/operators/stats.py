"""Counts, shares, word statistics and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.functions.text import URL, word_count_raw
from reviewlens.operators.splits import TEST, TRAIN, split_key
from reviewlens.session import stage


def row_counts(
    raw: DataFrame, text: str = "Review", rating: str = "Rating", train_percent: int = 80, method: str = "murmur3"
) -> DataFrame:
    """One row with the size of every preparation stage, from a single aggregation.

    All stages are conditions on (text, rating). They are evaluated in the scan, and duplicates are
    recognised by the SHA-256 sum of the text, so the texts themselves are not shuffled.
    """
    review, stars = F.trim(F.col(text)), F.col(rating).try_cast("double")
    clean = (review != "") & stars.isNotNull()
    facts = raw.select(
        F.sha2(text, 256).alias("content"),
        F.col(rating).alias("rating"),
        (F.col(text).isNotNull() & F.col(rating).isNotNull()).alias("present"),
        F.coalesce(clean, F.lit(False)).alias("clean"),
        (split_key([review, stars], method) < train_percent).alias("train"),
        F.regexp_replace(F.lower(review), URL, " ").rlike("[a-z]").alias("has_words"),
    )
    flags = ["present", "clean", "train", "has_words"]
    distinct = facts.groupBy("content", "rating", *flags).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("present"), F.col("copies"))), F.lit(0)).alias("present"),
        F.count_if("present").alias("distinct"),
        F.count_if("clean").alias("clean"),
        F.count_if(F.col("clean") & F.col("train")).alias("train"),
        F.count_if(F.col("clean") & ~F.col("train")).alias("test"),
        F.count_if(F.col("clean") & F.col("has_words")).alias("with_words"),
    )


def class_counts(df: DataFrame, label: str = "Sentiment", classes: Sequence | None = None) -> DataFrame:
    """Rows per class; with ``classes``, exactly these, 0 for one that does not occur."""
    if classes is None:
        return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counted = df.agg(*[F.count_if(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)])
    rows = [F.struct(F.lit(c).alias(label), F.col(f"n{i}").alias("n")) for i, c in enumerate(classes)]
    return counted.select(F.inline(F.array(*rows)))


def class_share(df: DataFrame, label: str = "Sentiment", positive="positive") -> DataFrame:
    """Positive rows, all rows, and the positive percentage (0 for an empty table)."""
    counts = df.agg(
        F.count_if(F.col(label) == positive).alias("positive"), F.count(F.lit(1)).alias("total")
    )
    share = F.coalesce(F.try_divide(F.col("positive") * 100.0, F.col("total")), F.lit(0.0))
    return counts.withColumn("share_percent", share)


def word_count_stats(df: DataFrame, words: str = "words", relative_error: float = 0.0001) -> DataFrame:
    """Mean, sample variance and deviation, and an approximate median (always a value that occurs)."""
    return df.agg(
        F.round(F.mean(words), 2).alias("mean"),
        F.round(F.variance(words), 2).alias("variance"),
        F.round(F.stddev(words), 2).alias("std"),
        F.percentile_approx(words, 0.5, int(1 / relative_error)).alias("median"),
    )


def _with_mean(histogram: DataFrame) -> DataFrame:
    """A histogram of ``w`` (words) and ``n`` (rows) with the mean: one row per different count, in one task."""
    w, known = F.col("w").cast("double"), F.when(F.col("w").isNotNull(), F.col("n"))
    everything = W.partitionBy()
    return histogram.withColumn("mean", F.sum(w * known).over(everything) / F.sum(known).over(everything))


def _word_moments() -> list[Column]:
    """Aggregates over a histogram with its mean. Distances to the mean keep all digits of the variance."""
    away, n = F.col("w").cast("double") - F.col("mean"), F.when(F.col("w").isNotNull(), F.col("n"))
    return [
        F.sum(n).alias("rows"),
        F.max("mean").alias("average"),
        F.sum(away * away * n).alias("squares"),
        F.percentile("w", 0.5, F.coalesce(n, F.lit(0))).alias("middle"),
    ]


def _word_figures(suffix: str = "") -> list[Column]:
    variance = F.when(F.col("rows") > 1, F.col("squares") / (F.col("rows") - 1))
    return [
        F.round("average", 2).alias(f"mean{suffix}"),
        F.round(variance, 2).alias(f"variance{suffix}"),
        F.round(F.sqrt(variance), 2).alias(f"std{suffix}"),
        F.round("middle", 2).alias(f"median{suffix}"),
    ]


def word_count_stats_exact(df: DataFrame, words: str = "words") -> DataFrame:
    """The same figures with the exact, interpolated median.

    The counts are first grouped into a histogram: its size is the number of different counts, not
    of rows, so the one task that finds the median holds little.
    """
    histogram = df.groupBy(F.col(words).cast("long").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return _with_mean(histogram).agg(*_word_moments()).select(*_word_figures())


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``total / (classes * rows of the class)`` per class. The window runs over one row per class."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = W.partitionBy()
    weight = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counts.withColumn("weight", weight)


def add_class_weights(df: DataFrame, label: str = "label", out: str = "classWeight") -> DataFrame:
    """Adds the weight of each row's class.

    The weights are a written table whose size Spark knows: it is broadcast while it is small, and
    joined by a shuffle, in which a large class is split between tasks, when there are very many
    classes. Rows without label have no weight.
    """
    weights = stage(class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias(out)), "class-weights")
    return df.drop(out).join(weights, F.col(label) == F.col("_class"), "left").drop("_class")


def dataset_stats(df: DataFrame, text: str, label: str, split: str = "split", positive=1, negative=0) -> DataFrame:
    """One row: split sizes, class counts and the exact word statistics of the raw text, in one scan."""
    histogram = df.groupBy(
        word_count_raw(F.col(text)).cast("long").alias("w"), F.col(split).alias("side"), F.col(label).alias("class")
    ).agg(F.count(F.lit(1)).alias("n"))
    return stats_of_histogram(histogram, positive, negative)


def stats_of_histogram(histogram: DataFrame, positive=1, negative=0) -> DataFrame:
    """The row of ``dataset_stats`` from ``(w, side, class, n)``: word counts, split sides, classes and rows."""

    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    totals = _with_mean(histogram).agg(
        rows_where(F.col("side") == TRAIN).alias("train_samples"),
        rows_where(F.col("side") == TEST).alias("test_samples"),
        rows_where(F.col("class") == negative).alias("negative_count"),
        rows_where(F.col("class") == positive).alias("positive_count"),
        *_word_moments(),
    )
    counts = ["train_samples", "test_samples", "negative_count", "positive_count"]
    return totals.select(*counts, *_word_figures("_word_count"))
