"""The nested record that feeds the charts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.text import DOMAIN_STOPWORDS_LONG, english_stopwords, keyword_tokens, word_count_raw
from reviewlens.operators.ranking import top_k_per_group
from reviewlens.operators.splits import TRAIN
from reviewlens.operators.stats import stats_of_histogram
from reviewlens.session import stage

# Names the chart readers expect.
STATS_FIELDS = {
    "train_samples": "trainSamples",
    "test_samples": "testSamples",
    "negative_count": "negativeCount",
    "positive_count": "positiveCount",
    "mean_word_count": "meanWordCount",
    "variance_word_count": "varianceWordCount",
    "std_word_count": "stdWordCount",
    "median_word_count": "medianWordCount",
}


def _part(df: DataFrame, name: str, value) -> DataFrame:
    """One row with one column of the record."""
    return df.agg(value.alias(name))


def review_counts(reviews: DataFrame, text: str, label: str) -> DataFrame:
    """``(side, class, w, word, n)`` from one scan: rows by number of words, and the keywords of train rows.

    A row gives one mark for its number of words, whose ``word`` is null, and one for each keyword, whose ``w`` is null.
    All marks are counted together, in each task before the shuffle. The outer form of ``inline`` keeps
    Catalyst from computing the keywords a second time in a filter.
    """

    def mark(w, word):
        return F.struct(w.cast("long").alias("w"), word.cast("string").alias("word"))

    words = F.when(F.col("split") == TRAIN, keyword_tokens(F.col(text)))
    none = F.lit(None)
    marks = F.concat(
        F.array(mark(word_count_raw(F.col(text)), none)),
        F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda word: mark(none, word)),
    )
    marked = reviews.select(F.col("split").alias("side"), F.col(label).alias("class"), F.inline_outer(marks))
    return marked.groupBy("side", "class", "w", "word").agg(F.count(F.lit(1)).alias("n"))


def dataset_payload(
    reviews: DataFrame,
    results: DataFrame,
    embedding_results: DataFrame,
    text: str = "text",
    label: str = "label",
    k: int = 120,
    notes: Mapping[str, str] | None = None,
    title: str = "Review statistics",
) -> DataFrame:
    """One row: statistics, class counts, model metrics, matrices, keywords and notes.

    ``reviews`` carries ``split`` and a 0/1 label; ``results`` are comparison rows with a matrix.
    The reviews are read once, for statistics, classes and keywords together. The parts are merged by one
    aggregation over as many rows as there are parts.
    """
    counts = stage(review_counts(reviews, text, label), "review-counts")
    stats = stats_of_histogram(counts.filter(F.col("word").isNull()).select("w", "side", "class", "n"))
    figures = F.struct(*[F.col(name).alias(field) for name, field in STATS_FIELDS.items()])
    balance = F.array(
        F.struct(F.lit("Negative").alias("label"), F.col("negative_count").alias("count")),
        F.struct(F.lit("Positive").alias("label"), F.col("positive_count").alias("count")),
    )
    parts = [stats.select(figures.alias("datasetStats"), balance.alias("classDistribution"))]

    def models(rows: DataFrame, extra: tuple[str, ...] = ()):
        names = ["Accuracy", "Precision", "Recall", "F1", *extra]
        row = F.struct(F.col("Method").alias("model"), *[F.col(name).alias(name.lower()) for name in names])
        return F.array_sort(F.collect_list(row))

    matrix = F.array(F.array("TN", "FP"), F.array("FN", "TP"))
    matrices = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("Method"), matrix.alias("matrix")))))
    parts.append(results.agg(models(results).alias("classicModels"), matrices.alias("classicConfusionMatrices")))
    extra = tuple(name for name in ("AUC",) if name in embedding_results.columns)
    parts.append(_part(embedding_results, "embeddingModels", models(embedding_results, extra)))

    named = F.when(F.col("class") == 1, "positive").when(F.col("class") == 0, "negative")
    stopwords = sorted({*english_stopwords(), *DOMAIN_STOPWORDS_LONG})
    words = (
        counts.filter(F.col("word").isNotNull() & ~F.col("word").isin(stopwords))
        .select(named.alias("label"), "word", F.col("n").alias("value"))
        .filter(F.col("label").isNotNull() & (F.col("word") != F.col("label")))
    )
    words = top_k_per_group(words, ["label"], [F.desc("value"), F.asc("word")], k)

    def ranked(name: str):
        entry = F.when(F.col("label") == name, F.struct("rank", "word", "value"))
        listed = F.array_sort(F.collect_list(entry))
        return F.transform(listed, lambda w: F.struct(w["word"].alias("word"), w["value"].alias("value")))

    parts.append(
        words.agg(ranked("positive").alias("positiveKeywords"), ranked("negative").alias("negativeKeywords"))
    )
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    record = merged.agg(*[F.first(name, ignorenulls=True).alias(name) for name in merged.columns])
    pairs = [F.lit(x) for pair in (notes or {"reproducibility": "rebuild after data updates"}).items() for x in pair]
    return record.select(
        F.struct(F.lit(title).alias("title"), F.array(F.lit("Negative"), F.lit("Positive")).alias("classLabels")).alias("meta"),
        "*",
        F.create_map(*pairs).alias("notes"),
    )
