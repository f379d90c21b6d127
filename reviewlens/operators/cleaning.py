"""Cleaning of raw review rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_review_cols(df: DataFrame, text: str = "Review", rating: str = "Rating") -> DataFrame:
    return df.select(text, rating)


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def dedup_reviews(df: DataFrame, columns: Sequence[str] = ("Review", "Rating")) -> DataFrame:
    """One row per distinct combination of ``columns``.

    Copies collapse in the map-side aggregation, so a text that makes up much of the data
    is shuffled once per task, not once per copy.
    """
    return df.dropDuplicates(list(columns))


def trim_nonempty(df: DataFrame, text: str = "Review") -> DataFrame:
    """Trim spaces (not tabs or newlines) and drop rows left empty."""
    return df.withColumn(text, F.trim(text)).filter(F.col(text) != "")


def cast_rating(df: DataFrame, rating: str = "Rating") -> DataFrame:
    """Rating as double; rows whose rating is no number are dropped."""
    return df.withColumn(rating, F.col(rating).try_cast("double")).dropna(subset=[rating])


def clean_reviews(df: DataFrame, text: str = "Review", rating: str = "Rating") -> DataFrame:
    """Keep two columns, drop missing, drop copies, trim, cast: in this order.

    Copies are compared before trimming, so ``' a'`` and ``'a'`` both stay. The trim and cast
    filters depend on the grouping columns only; Catalyst moves them below the shuffle.
    """
    present = drop_missing(project_review_cols(df, text, rating), [text, rating])
    return cast_rating(trim_nonempty(dedup_reviews(present, [text, rating]), text), rating)
