"""Sentiment labels."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSITIVE, NEGATIVE = "positive", "negative"


def label_from_rating(
    df: DataFrame,
    rating: str = "Rating",
    out: str = "Sentiment",
    threshold: float = 3.0,
    three_as_positive: bool = True,
) -> DataFrame:
    """Positive from ``threshold`` on (or above it only), else negative."""
    value = F.col(rating)
    positive = value >= threshold if three_as_positive else value > threshold
    return df.withColumn(out, F.when(positive, POSITIVE).otherwise(NEGATIVE))


def sentiment_code(sentiment: Column, positive_label: float = 1.0) -> Column:
    """Numeric label of a sentiment text, whatever its case and padding; null if unknown."""
    name = F.lower(F.trim(sentiment))
    return F.when(name == POSITIVE, positive_label).when(name == NEGATIVE, 1.0 - positive_label)


def align_labels(
    df: DataFrame,
    text: str = "Review",
    rating: str = "Rating",
    sentiment: str = "Sentiment",
    positive_label: float = 1.0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows as ``(text, Rating, label)``; rows without text or known sentiment are dropped."""
    return df.select(
        *keep,
        F.col(text).cast("string").alias("text"),
        F.col(rating).alias("Rating"),
        sentiment_code(F.col(sentiment), positive_label).cast("double").alias("label"),
    ).dropna(subset=["text", "label"])


def binary_label(sentiment: Column) -> Column:
    """1 for exactly 'positive', 0 for anything else, null included."""
    return F.when(sentiment == POSITIVE, 1).otherwise(0).cast("int")


def filter_by_label(df: DataFrame, label: str, value) -> DataFrame:
    return df.filter(F.col(label) == value)


def filter_empty_tokens(df: DataFrame, tokens: str = "words") -> DataFrame:
    return df.filter(F.size(tokens) > 0)


def fit_label_index(df: DataFrame, column: str, out: str = "label", on_unseen: str = "skip") -> StringIndexerModel:
    """Indexer by falling frequency, equal frequencies in alphabetical order."""
    return StringIndexer(
        inputCol=column, outputCol=out, stringOrderType="frequencyDesc", handleInvalid=on_unseen
    ).fit(df)


def index_label(df: DataFrame, column: str, out: str = "label", on_unseen: str = "skip") -> DataFrame:
    return fit_label_index(df, column, out, on_unseen).transform(df)
