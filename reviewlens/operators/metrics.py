"""Classification metrics from one distributed aggregation of (label, prediction) pairs.

Every function starts from the confusion cells: at most classes x classes rows per method. Rows of
predictions are never collected. ``by`` names columns, such as the method, to evaluate separately
in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.session import stage


def confusion_cells(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def crosstab_predictions(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence = (0, 1)
) -> DataFrame:
    """One row per label with a count column per predicted class."""
    columns = [F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes]
    return df.groupBy(F.col(label).alias("label")).agg(*columns)


def _matrix(label: str, prediction: str, weight: Column | None = None) -> list[Column]:
    def cell(actual: int, predicted: int, name: str) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        count = F.count_if(hit) if weight is None else F.coalesce(F.sum(F.when(hit, weight)), F.lit(0))
        return count.alias(name)

    return [cell(0, 0, "TN"), cell(0, 1, "FP"), cell(1, 0, "FN"), cell(1, 1, "TP")]


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Counts for labels 0 and 1, zero-filled, as TN, FP, FN, TP."""
    return df.groupBy(*by).agg(*_matrix(label, prediction))


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def per_class(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    as_label = F.struct(
        F.col("label").alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("hits")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("hits")
    )
    counts = (
        cells.select(*by, F.inline(F.array(as_label, as_prediction)))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    return counts.select(
        *by,
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(class, precision, recall, f1, support)`` per class, then accuracy and both averages."""
    classes = per_class(confusion_cells(df, label, prediction, by), by)
    figures = ["precision", "recall", "f1"]
    support = F.sum("support")
    means = [F.avg(name).alias(f"macro_{name}") for name in figures]
    weighted = [_ratio(F.sum(F.col(name) * F.col("support")), support).alias(f"weighted_{name}") for name in figures]
    rows = F.collect_list(F.struct(F.col("class").cast("string").alias("class"), *figures, "support"))
    totals = classes.groupBy(*by).agg(
        rows.alias("rows"),
        *means,
        *weighted,
        support.alias("support"),
        _ratio(F.sum("hits"), support).alias("accuracy"),
    )

    def summary(name: str, *values: Column) -> Column:
        named = [value.alias(figure) for figure, value in zip(figures, values)]
        return F.struct(F.lit(name).alias("class"), *named, F.col("support"))

    accuracy = F.col("accuracy")
    extra = F.array(
        summary("accuracy", accuracy, accuracy, accuracy),
        summary("macro avg", *[F.col(f"macro_{name}") for name in figures]),
        summary("weighted avg", *[F.col(f"weighted_{name}") for name in figures]),
    )
    return totals.select(*by, F.inline(F.concat("rows", extra)))


def weighted_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    classes = per_class(confusion_cells(df, label, prediction, by), by)
    return classes.groupBy(*by).agg(*_weighted(digits))


def _weighted(digits: int | None) -> list[Column]:
    total = F.sum("support")

    def shown(value: Column, name: str) -> Column:
        return (value if digits is None else F.round(value, digits)).alias(name)

    return [
        shown(_ratio(F.sum("hits"), total), "Accuracy"),
        shown(_ratio(F.sum(F.col("precision") * F.col("support")), total), "Precision"),
        shown(_ratio(F.sum(F.col("recall") * F.col("support")), total), "Recall"),
        shown(_ratio(F.sum(F.col("f1") * F.col("support")), total), "F1"),
    ]


def by_label_metrics(
    df: DataFrame, value: float = 1.0, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 of one class."""
    classes = per_class(confusion_cells(df, label, prediction, by), by)
    return classes.filter(F.col("class") == value).select(*by, "class", "precision", "recall", "f1")


def binary_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1 only."""
    m = confusion_matrix(df, label, prediction, by)
    tn, fp, fn, tp = (F.col(name) for name in ("TN", "FP", "FN", "TP"))
    figures = {
        "Accuracy": _ratio(tn + tp, tn + fp + fn + tp),
        "Precision": _ratio(tp, tp + fp),
        "Recall": _ratio(tp, tp + fn),
        "F1": _ratio(2 * tp, 2 * tp + fp + fn),
    }
    shown = [(v if digits is None else F.round(v, digits)).alias(name) for name, v in figures.items()]
    return m.select(*by, *shown, "TN", "FP", "FN", "TP")


def metrics_rows(
    df: DataFrame,
    method: str = "Method",
    label: str = "label",
    prediction: str = "prediction",
    digits: int | None = 4,
) -> DataFrame:
    """One comparison row per method: weighted metrics and the 2 x 2 matrix, in one job."""
    cells = confusion_cells(df, label, prediction, [method])
    together = W.partitionBy(method)
    matrix = {
        name: F.sum(F.when((F.col("label") == a) & (F.col("prediction") == p), F.col("n")).otherwise(0)).over(together)
        for name, a, p in (("TN", 0, 0), ("FP", 0, 1), ("FN", 1, 0), ("TP", 1, 1))
    }
    wide = cells.select("*", *[column.alias(name) for name, column in matrix.items()])
    keys = [method, "TN", "FP", "FN", "TP"]
    figures = per_class(wide, keys).groupBy(*keys).agg(*_weighted(digits))
    return figures.select(method, "Accuracy", "Precision", "Recall", "F1", "TN", "FP", "FN", "TP")


# --- ranking metrics -------------------------------------------------------------------------


def _score_ranges(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score, and the range (``bucket``) of scores it falls in.

    A running sum over all scores would need them in one task. Distinct scores are dealt to as many
    ranges as there are shuffle partitions, from the highest down, so sums can run within a range and
    over the ranges. Where they are cut only balances the work: any cut gives the exact sums. The ranges
    are written once, so that both sums see the same. A null label, and a score that is null or not a
    number, raise an error: leaving such rows out would change the area unseen.
    """
    value = F.col(score).cast("double")
    bad = F.col(label).isNull() | value.isNull() | F.isnan(value)
    checked = F.when(bad, F.raise_error(F.lit("null label, or score that is null or not a number"))).otherwise(value)
    positive = F.col("label") == 1
    counts = (
        df.select(*by, F.col(label).alias("label"), checked.cast("double").alias("score"))
        .groupBy(*by, "score")
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    ranged = counts.repartitionByRange(*by, F.desc("score")).withColumn("bucket", F.spark_partition_id())
    return stage(ranged, "score-ranges")


def score_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives there (``pos``, ``neg``) and at or above it (``tp``, ``fp``)."""
    ranged = _score_ranges(df, label, score, by)
    inside = W.partitionBy(*by, "bucket").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    above = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy(*by, "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    offsets = sums.select(
        *(F.col(name).alias(f"_{name}") for name in (*by, "bucket")),
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("neg_above"),
    )
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in (*by, "bucket")))
    running = ranged.withColumn("pos_sum", F.sum("pos").over(inside)).withColumn("neg_sum", F.sum("neg").over(inside))
    return running.join(offsets, same).select(
        *by,
        "score",
        "pos",
        "neg",
        (F.col("pos_sum") + F.col("pos_above")).alias("tp"),
        (F.col("neg_sum") + F.col("neg_above")).alias("fp"),
    )


def auc_roc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve; null when a class is missing.

    It is the share of (positive, negative) pairs that the score orders rightly, ties counting half:
    pairs within a range of scores, plus all positives of the ranges above times the negatives.
    """
    ranged = _score_ranges(df, label, score, by)
    inside = W.partitionBy(*by, "bucket").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    above = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    pairs = (F.sum("pos").over(inside) - F.col("pos") / 2) * F.col("neg")
    ranges = (
        ranged.withColumn("pairs", pairs)
        .groupBy(*by, "bucket")
        .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn("pos_above", F.coalesce(F.sum("pos").over(above), F.lit(0)).cast("double"))
    )
    ordered = F.sum(F.col("pairs") + F.col("pos_above") * F.col("neg"))
    return ranges.groupBy(*by).agg(F.try_divide(ordered, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def auc_pr(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the precision-recall curve by trapezoids, starting at the first precision."""
    curve = score_curve(df, label, score, by)
    seen = F.col("tp") + F.col("fp")
    before = seen - F.col("pos") - F.col("neg")
    precision = F.col("tp") / seen
    previous = F.when(before > 0, F.try_divide(F.col("tp") - F.col("pos"), before)).otherwise(precision)
    area = F.sum(F.col("pos") * (precision + previous) / 2)
    return curve.groupBy(*by).agg(F.try_divide(area, F.sum("pos")).alias("auc_pr"))
