"""Keyword lists and vocabularies."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.text import DOMAIN_STOPWORDS_LONG, english_stopwords, keyword_tokens
from reviewlens.operators.ranking import top_k_per_group


def keyword_counts(
    df: DataFrame,
    text: str = "Review",
    label: str = "Sentiment",
    stopwords: Iterable[str] | None = None,
    drop_class_name: bool = True,
) -> DataFrame:
    """``(label, word, value)``: how often each word occurs per class.

    Words are counted per task before the shuffle: a frequent word costs one row per task.
    """
    if stopwords is None:
        stopwords = [*english_stopwords(), *DOMAIN_STOPWORDS_LONG]
    words = df.select(F.col(label).alias("label"), F.explode_outer(keyword_tokens(F.col(text))).alias("word"))
    kept = words.filter(~F.col("word").isin(sorted(set(stopwords))))
    if drop_class_name:
        kept = kept.filter(F.col("word") != F.lower(F.col("label").cast("string")))
    return kept.groupBy("label", "word").agg(F.count(F.lit(1)).alias("value"))


def top_keywords(
    df: DataFrame,
    text: str = "Review",
    label: str = "Sentiment",
    k: int = 120,
    stopwords: Iterable[str] | None = None,
    drop_class_name: bool = True,
) -> DataFrame:
    """The ``k`` most frequent words per class as ``(label, word, value, rank)``; ties by word.

    The ranking only sees distinct words and is cut to ``k`` per class in every task.
    """
    counted = keyword_counts(df, text, label, stopwords, drop_class_name)
    return top_k_per_group(counted, ["label"], [F.desc("value"), F.asc("word")], k)


def vocab_document_freq(
    df: DataFrame, tokens: str, min_df: int = 2, vocab_size: int = 10_000, with_rows: bool = False
) -> DataFrame:
    """The ``vocab_size`` most frequent terms among those in at least ``min_df`` rows.

    Returns ``(term, n, df)``: occurrences and number of rows; ties by term. Each row contributes
    its tokens once for ``n`` and its distinct tokens once for ``df``, so both come from one
    aggregation without a distinct count. ``with_rows`` adds a record with a null term whose ``df``
    is the number of rows of the input, from the same pass. The final ordering keeps ``vocab_size``
    rows per task.

    The outer form of ``inline`` matters: for the plain form Catalyst adds a filter that computes
    the tokens a second time.
    """
    token = F.coalesce(F.col(tokens), F.array().cast("array<string>"))

    def mark(term, n: int, rows: int):
        return F.struct(term.alias("term"), F.lit(n).cast("long").alias("n"), F.lit(rows).cast("long").alias("df"))

    marks = F.concat(
        F.array(mark(F.lit(None).cast("string"), 0, 1)),
        F.transform(token, lambda t: mark(t, 1, 0)),
        F.transform(F.array_distinct(token), lambda t: mark(t, 0, 1)),
    )
    totals = df.select(F.inline_outer(marks)).groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    term = F.col("term")
    if not with_rows:
        kept = totals.filter(term.isNotNull() & (F.col("df") >= min_df))
        return kept.orderBy(F.desc("n"), F.asc("term")).limit(vocab_size)
    kept = totals.filter(term.isNull() | (F.col("df") >= min_df))
    return kept.orderBy(term.isNotNull(), F.desc("n"), F.asc("term")).limit(vocab_size + 1)
