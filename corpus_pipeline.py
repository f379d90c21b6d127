"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import best_fit_packing, exact_dedup, near_dedup, quality_classifier, source_mixing
from reviewlens.llm.columns import set_aside
from reviewlens.session import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _kept(docs: DataFrame, results: Sequence[str], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows that ``judge`` returns, with the columns of ``docs`` as they were, even those named like results."""
    held, back = set_aside(docs, *results)
    return judge(held).drop(*results).withColumnsRenamed(back).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the ``labels`` of documents given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    return _kept(docs, ("score", "predicted"), lambda d: quality_classifier.with_scores(d, model).filter("predicted = 1"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return _kept(docs, exact_dedup.RESULT, lambda d: exact_dedup.exact_dedup(d).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-duplicate pairs, the one with the smallest id stays."""
    return _kept(docs, near_dedup.RESULT, lambda d: near_dedup.near_dedup(d).filter("kept"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken; documents are whole."""
    rows = _kept(docs, source_mixing.RESULT, lambda d: source_mixing.mixed_rows(source_mixing.mix_sources(d)))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 4096 tokens."""
    return best_fit_packing.pack(best_fit_packing.pieces(docs, TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact duplicates", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``. Each stage's rows are a written table, so none is computed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The quality model and the tokenizer have no SQL form; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL = None
