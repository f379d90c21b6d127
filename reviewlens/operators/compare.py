"""Comparison tables. Their size is the number of methods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_models(*results: DataFrame) -> DataFrame:
    """All result rows, the first per method, best F1 and then best accuracy first."""
    tagged = [rows.withColumn("_table", F.lit(i)) for i, rows in enumerate(results)]
    together = tagged[0]
    for rows in tagged[1:]:
        together = together.unionByName(rows, allowMissingColumns=True)
    others = [name for name in together.columns if name not in ("Method", "_table")]
    first = together.groupBy("Method").agg(F.min_by(F.struct(*others), F.struct("_table", *others)).alias("row"))
    return first.select("Method", "row.*").orderBy(F.desc("F1"), F.desc("Accuracy"), "Method")


def best_model(results: DataFrame, by: Sequence[str] = ("F1", "Accuracy")) -> DataFrame:
    """The method with the highest value of ``by[0]``, then ``by[1]``; ties by name."""
    figures = [name for name in ("Accuracy", "Precision", "Recall", "F1") if name in results.columns]
    order = F.struct(*[-F.col(name) for name in by], F.col("Method"))
    best = results.agg(F.min_by(F.struct("Method", *figures), order).alias("best"))
    return best.select("best.*")


def unpivot_metrics(results: DataFrame, metrics: Sequence[str] = ("Accuracy", "Precision", "Recall", "F1")) -> DataFrame:
    """``(Model, Metric, Score)`` rows; missing scores are dropped."""
    model = F.col("Method").alias("Model")
    wide = results.select(model, *[F.col(name).cast("double").alias(name) for name in metrics])
    return wide.unpivot("Model", list(metrics), "Metric", "Score").dropna(subset=["Score"])
