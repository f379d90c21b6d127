"""Cross-validation with stratified folds that depend on the row content only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model
from pyspark.ml.base import Estimator
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.functions.hashing import joined, md5_number
from reviewlens.operators.metrics import confusion_cells, per_class
from reviewlens.operators.models import SEED, dealt_for
from reviewlens.session import stage

# The tuned parameters of each method.
DECISION_TREE_GRID = {
    "maxDepth": [4],
    "impurity": ["gini"],
    "maxBins": [128],
    "minInstancesPerNode": [7],
    "minInfoGain": [0.0],
    "minWeightFractionPerNode": [0.0],
}
RANDOM_FOREST_GRID = {"featureSubsetStrategy": ["0.5"], "minInfoGain": [0.01], "minInstancesPerNode": [2]}
GBT_GRID = {"maxDepth": [4], "weightCol": ["classWeight"]}


def add_fold(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = SEED, out: str = "fold") -> DataFrame:
    """A fold per row by a hash of its ``key``. A rare class may be missing from a fold; see ``stratified_fold``."""
    number = md5_number(joined(F.lit(seed), *[F.col(name) for name in key]))
    return df.withColumn(out, (number % folds).cast("int"))


def stratified_fold(
    df: DataFrame, key: Sequence[str], label: str = "label", folds: int = 5, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """A fold per row, so that each class is spread evenly: fold sizes of a class differ by one row at most.

    The rows of a class are dealt round robin in the order of a seeded hash of their ``key``, which is unique. They
    are numbered within 4096 ranges of the hash, and the rows in the ranges before are added, so that no task
    sees more than its ranges of a class. Every class with at least ``folds`` rows is in every fold; null is a
    class like any other.
    """
    digest = F.md5(joined(F.lit(seed), *[F.col(name) for name in key]))
    ranged = df.withColumns({"_digest": digest, "_range": F.substring(digest, 1, 3), "_class": F.col(label)})
    before = W.partitionBy("_class").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("_class", "_range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("_class").alias("_of"), F.col("_range").alias("_in"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    inside = W.partitionBy("_class", "_range").orderBy("_digest", *key)
    numbered = ranged.withColumn("_place", F.row_number().over(inside))
    placed = numbered.join(starts, F.col("_class").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in")))
    fold = ((F.col("_start") + F.col("_place") - 1) % folds).cast("int")
    return placed.withColumn(out, fold).drop("_digest", "_range", "_class", "_of", "_in", "_place", "_start")


@dataclass(frozen=True)
class Tuned:
    """The winning ``model``, fitted on all rows, its ``params``, and a row of ``scores`` per candidate.

    ``scores`` is ``(candidate, params, score, best)``: the mean over the folds. ``fold_scores`` has the single ones.
    """

    model: Model
    params: dict
    scores: DataFrame
    fold_scores: DataFrame


def class_score(metric: str, value: float = 1.0) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """Function from predictions to ``(by, score)``: ``precision``, ``recall`` or ``f1`` of one class.

    It is read off the confusion cells and is zero where the class occurs neither as label nor as prediction.
    """

    def score(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
        cells = stage(confusion_cells(predictions, by=by), "cells")
        found = per_class(cells, by).filter(F.col("class") == value).select(*by, F.col(metric).alias("score"))
        return cells.select(*by).distinct().join(found, list(by), "left").select(*by, F.coalesce("score", F.lit(0.0)).alias("score"))

    return score


def _named(params: Mapping) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda item: item[0].name))


def cross_validate(
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    score: Callable[[DataFrame, Sequence[str]], DataFrame],
    train: DataFrame,
    fold: str = "fold",
    folds: int = 5,
    parallelism: int = 2,
) -> Tuned:
    """Fits every candidate of ``grid`` on all folds but one, for each fold, and keeps the best by mean ``score``.

    The predictions for the held-out folds of all candidates are one table, scored in one job. Of candidates with
    equal means, to twelve digits, the first in the grid wins. ``fold`` holds 0 to ``folds - 1``; a fold without rows is an error.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), list(values))
    candidates = builder.build()
    rows = {r[0] for r in train.select(fold).distinct().collect()}
    if rows != set(range(folds)):
        raise ValueError(f"folds 0 to {folds - 1} are expected, found {sorted(rows, key=str)}")

    dealt = dealt_for(estimator, train)

    def held_out(work: tuple[int, int]) -> DataFrame:
        number, candidate = work
        model = estimator.fit(dealt.filter(F.col(fold) != number), candidates[candidate])
        predicted = model.transform(train.filter(F.col(fold) == number))
        return predicted.select(
            F.lit(candidate).alias("candidate"), F.lit(number).alias("fold"), F.col("label").cast("double").alias("label"), "prediction"
        )

    work = [(number, candidate) for number in range(folds) for candidate in range(len(candidates))]
    with ThreadPool(parallelism) as pool:
        tables = pool.map(held_out, work)
    predictions = tables[0]
    for more in tables[1:]:
        predictions = predictions.unionByName(more)
    fold_scores = stage(score(stage(predictions, "held-out"), ["candidate", "fold"]), "fold-scores")
    means = {r["candidate"]: r["score"] for r in fold_scores.groupBy("candidate").agg(F.round(F.avg("score"), 12).alias("score")).collect()}
    best = max(means, key=lambda c: (means[c], -c))
    table = [(c, _named(candidates[c]), float(means[c]), c == best) for c in sorted(means)]
    scores = train.sparkSession.createDataFrame(table, "candidate int, params string, score double, best boolean")
    chosen = {p.name: v for p, v in candidates[best].items()}
    return Tuned(estimator.fit(dealt, candidates[best]), chosen, scores, fold_scores)


def cv_decision_tree(train: DataFrame, grid: Mapping[str, Sequence] = DECISION_TREE_GRID, **options) -> Tuned:
    tree = DecisionTreeClassifier(maxDepth=10, weightCol="classWeight", seed=SEED)
    return cross_validate(tree, grid, class_score("f1"), train, **options)


def cv_random_forest(train: DataFrame, grid: Mapping[str, Sequence] = RANDOM_FOREST_GRID, **options) -> Tuned:
    forest = RandomForestClassifier(numTrees=50, maxDepth=10, weightCol="classWeight", seed=SEED)
    return cross_validate(forest, grid, class_score("recall"), train, **options)


def cv_gbt(train: DataFrame, grid: Mapping[str, Sequence] = GBT_GRID, **options) -> Tuned:
    boosted = GBTClassifier(maxIter=50, maxDepth=5, seed=SEED)
    return cross_validate(boosted, grid, class_score("recall"), train, **options)


def best_params(tuned: Tuned) -> DataFrame:
    """``(param, value, tuned)`` of the winning model: all its parameters, and which of them the grid chose."""
    rows = sorted((p.name, str(v), p.name in tuned.params) for p, v in tuned.model.extractParamMap().items())
    return tuned.scores.sparkSession.createDataFrame(rows, "param string, value string, tuned boolean")
