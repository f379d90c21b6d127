"""TF-IDF features as ML vectors, and the same numbers in long form."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.functions.text import english_stopwords
from reviewlens.operators.keywords import vocab_document_freq
from reviewlens.session import stage


def tokenizer_stages(text: str, kind: str) -> list:
    """Stages from text to ``tokens``: 'letters', 'nonword' or 'ngrams'."""
    if kind == "letters":
        cleaning = f"SELECT *, lower(regexp_replace(`{text}`, '[^a-zA-Z]', ' ')) AS clean_text FROM __THIS__"
        splitting = RegexTokenizer(inputCol="clean_text", outputCol="tokens", pattern=r"\s+")
        return [SQLTransformer(statement=cleaning), splitting]
    if kind == "nonword":
        return [RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\W+", toLowercase=True)]
    if kind == "ngrams":
        words = rf"regexp_extract_all(lower(`{text}`), r'[\p{{L}}\p{{N}}_]{{2,}}', 0)"
        pairs = "greatest(size(w) - 1, 0)"
        both = f"concat(w, zip_with(slice(w, 1, {pairs}), slice(w, 2, {pairs}), (a, b) -> concat_ws(' ', a, b)))"
        statement = f"SELECT * EXCEPT (w), {both} AS tokens FROM (SELECT *, {words} AS w FROM __THIS__)"
        return [SQLTransformer(statement=statement)]
    raise ValueError(f"unknown tokenizer {kind!r}")


def _through(df: DataFrame, stages: list) -> DataFrame:
    for transformer in stages:
        df = transformer.transform(df)
    return df


def count_vectorizer(
    df: DataFrame, tokens: str, out: str = "raw_features", vocab_size: int = 10_000, min_df: int = 2
) -> tuple[CountVectorizerModel, list[int], int]:
    """A term-count model, the document frequency of each of its terms, and the number of rows.

    The vocabulary is the one ``CountVectorizer`` learns, except that equally frequent terms are
    ordered alphabetically: the features are the same however the rows are partitioned. All of it
    comes from one pass over the data; at most ``vocab_size`` terms reach the driver,
    as every ``CountVectorizerModel`` holds them there.
    """
    found = vocab_document_freq(df, tokens, min_df, vocab_size, with_rows=True).collect()
    rows = sum(row["df"] for row in found if row["term"] is None)
    terms = [row for row in found if row["term"] is not None]
    if not terms:
        raise ValueError(f"no term occurs in {min_df} rows")
    model = CountVectorizerModel.from_vocabulary([row["term"] for row in terms], inputCol=tokens, outputCol=out)
    return model, [row["df"] for row in terms], rows


def fit_text_features(
    train: DataFrame,
    text: str = "Review",
    tokenizer: str = "letters",
    vocab_size: int = 10_000,
    min_df: int = 2,
) -> PipelineModel:
    """Text to TF-IDF vector (column ``features``), fitted on ``train`` only.

    'letters' and 'nonword' drop stop words and weigh by ``ln((m + 1) / (df + 1))``. 'ngrams' keeps
    single words and pairs, weighs by that plus one, and scales each vector to length one.
    """
    stages, tokens = _token_stages(text, tokenizer)
    return PipelineModel([*stages, *_weighing_stages(_through(train, stages).select(tokens), tokens, tokenizer, vocab_size, min_df)])


def fit_text_vectors(
    train: DataFrame, text: str, tokenizer: str, keep: Sequence[str], vocab_size: int = 10_000, min_df: int = 2
) -> tuple[PipelineModel, DataFrame]:
    """The stages of ``fit_text_features``, and the ``keep`` columns of ``train`` with ``features``.

    The tokens of ``train`` are written, so that its texts are cut once and not for the fit and the vectors each.
    """
    stages, tokens = _token_stages(text, tokenizer)
    written = stage(_through(train, stages).select(*dict.fromkeys(keep), tokens), "train-tokens")
    weighing = _weighing_stages(written.select(tokens), tokens, tokenizer, vocab_size, min_df)
    return PipelineModel([*stages, *weighing]), PipelineModel(weighing).transform(written).select(*dict.fromkeys(keep), "features")


def _token_stages(text: str, tokenizer: str) -> tuple[list, str]:
    """Stages from text to the tokens that count, and the name of their column."""
    stages = tokenizer_stages(text, tokenizer)
    if tokenizer == "ngrams":
        return stages, "tokens"
    remover = StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", stopWords=english_stopwords())
    return [*stages, remover], "filtered_tokens"


def _weighing_stages(train: DataFrame, tokens: str, tokenizer: str, vocab_size: int, min_df: int) -> list:
    """Stages from tokens to ``features``, fitted on the tokens of ``train``."""
    counts, frequencies, rows = count_vectorizer(train, tokens, vocab_size=vocab_size, min_df=min_df)
    smooth = 1.0 if tokenizer == "ngrams" else 0.0
    weights = Vectors.dense([math.log((rows + 1) / (df + 1)) + smooth for df in frequencies])
    weighted = "weighted" if tokenizer == "ngrams" else "features"
    product = ElementwiseProduct(scalingVec=weights, inputCol="raw_features", outputCol=weighted)
    return [counts, product, *([Normalizer(p=2.0, inputCol=weighted, outputCol="features")] if tokenizer == "ngrams" else [])]


def vocabulary(model: PipelineModel) -> list[str]:
    return next(stage for stage in model.stages if isinstance(stage, CountVectorizerModel)).vocabulary


def term_counts(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """``(key, term, tf)``, dealt by key. Rows that share a key are one.

    The rows move with their tokens as they are, which is less than a row per term, and are counted where they arrive.
    """
    exploded = df.select(key, tokens).repartition(key).select(key, F.explode_outer(tokens).alias("term"))
    return exploded.filter(F.col("term").isNotNull()).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_long(
    df: DataFrame,
    key: str,
    tokens: str,
    vocab_size: int = 10_000,
    min_df: int = 2,
    smooth: bool = False,
    normalize: bool = False,
) -> DataFrame:
    """``(key, term, tf, tfidf)`` for the terms of the vocabulary.

    ``smooth`` adds one to the inverse document frequency; ``normalize`` scales each row's values to
    Euclidean length one. The vocabulary has at most ``vocab_size`` rows, and Spark
    broadcasts it while it is small. The counts stay where the rows of a key are, and so do the lengths.
    """
    counted = term_counts(df, key, tokens)
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    kept = (
        counted.groupBy("term")
        .agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_df)
        .orderBy(F.desc("n"), F.asc("term"))
        .limit(vocab_size)
    )
    idf = F.log((rows + 1) / (F.col("df") + 1)) + F.lit(1.0 if smooth else 0.0)
    weights = kept.select("term", idf.alias("idf"))
    weighted = counted.join(weights, "term").select(key, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    if not normalize:
        return weighted
    length = F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf")).over(W.partitionBy(key)))
    scaled = weighted.select(key, "term", "tf", (F.col("tfidf") / length).alias("tfidf"))
    return scaled.filter(F.col(key).isNotNull())
