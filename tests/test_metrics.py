"""Metrics against published matrices, Spark ML evaluators and brute force."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from reviewlens.operators import metrics, thresholds
from reviewlens.operators.compare import best_model, compare_models, unpivot_metrics

# Fixed values: [[tn, fp], [fn, tp]] and weighted accuracy, precision, recall, F1.
GOLDEN = {
    "tree": ([[11, 12], [83, 186]], (0.6747, 0.8746, 0.6747, 0.7486)),
    "forest": ([[1, 22], [0, 269]], (0.9247, 0.9304, 0.9247, 0.8916)),
    "boosting": ([[1, 22], [6, 263]], (0.9041, 0.8614, 0.9041, 0.8799)),
    "baseline": ([[12, 11], [67, 202]], (0.7329, 0.8856, 0.7329, 0.7907)),
    "logistic": ([[4, 19], [11, 258]], (0.8973, 0.8790, 0.8973, 0.8872)),
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = [
        (name, float(a), float(p))
        for name, (matrix, _) in GOLDEN.items()
        for a in (0, 1)
        for p in (0, 1)
        for _ in range(matrix[a][p])
    ]
    return spark.createDataFrame(rows, "Method string, label double, prediction double")


def test_golden_matrices(golden):
    for row in metrics.metrics_rows(golden).collect():
        matrix, figures = GOLDEN[row["Method"]]
        assert [[row["TN"], row["FP"]], [row["FN"], row["TP"]]] == matrix
        assert (row["Accuracy"], row["Precision"], row["Recall"], row["F1"]) == figures


def test_report_and_evaluators_agree(golden):
    tree = golden.filter(F.col("Method") == "tree")
    report = {r["class"]: r for r in metrics.classification_report(tree).collect()}
    for metric, column in (("weightedPrecision", "precision"), ("weightedRecall", "recall"), ("f1", "f1")):
        value = MulticlassClassificationEvaluator(metricName=metric).evaluate(tree)
        assert report["weighted avg"][column] == pytest.approx(value)
    by_label = metrics.by_label_metrics(tree, 1.0).first()
    for metric, column in (("recallByLabel", "recall"), ("fMeasureByLabel", "f1")):
        value = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0).evaluate(tree)
        assert by_label[column] == pytest.approx(value)
    assert report["accuracy"]["support"] == tree.count()


def test_one_class_only(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.3), (1.0, 0.0, 0.9)], "label double, prediction double, score double")
    row = metrics.binary_metrics(df).first()
    assert (row["TN"], row["FP"], row["FN"], row["TP"]) == (0, 0, 1, 1)
    assert metrics.weighted_metrics(df).first()["Recall"] == 0.5
    assert metrics.auc_roc(df).first()["auc"] is None


def test_empty(spark):
    df = spark.createDataFrame([], "label double, prediction double, score double")
    assert metrics.confusion_matrix(df).first()["TP"] == 0
    assert metrics.classification_report(df).first()["support"] in (None, 0)
    assert metrics.auc_roc(df).first()["auc"] is None
    assert thresholds.best_threshold(thresholds.threshold_sweep(df)).first() == (0.5, -1.0)


@pytest.mark.parametrize("distinct", [1, 7, 5000])
def test_areas_equal_the_evaluator(spark, distinct):
    rng = np.random.default_rng(distinct)
    scores = rng.integers(0, distinct, 4000) / distinct
    # a third of all rows share one score
    scores[:1300] = scores[0]
    labels = (rng.random(4000) < 0.2 + 0.5 * scores).astype(float)
    df = spark.createDataFrame(list(zip(labels.tolist(), scores.tolist())), "label double, score double")
    for area, metric, column in (
        (metrics.auc_roc, "areaUnderROC", "auc"),
        (metrics.auc_pr, "areaUnderPR", "auc_pr"),
    ):
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0)
        assert area(df).first()[column] == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    curve = metrics.score_curve(df)
    assert curve.agg(F.max("tp"), F.max("fp")).first() == (labels.sum(), (1 - labels).sum())


def test_areas_by_group(spark):
    rows = [(m, float(i % 3 == 0), float(i % k)) for m, k in ((None, 7), ("a", 50), ("b", 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "m string, label double, score double")
    got = {r["m"]: r["auc"] for r in metrics.auc_roc(df, by=["m"]).collect()}
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    for m in (None, "a", "b"):
        assert got[m] == pytest.approx(evaluator.evaluate(df.filter(df["m"].eqNullSafe(m))), abs=1e-9)
    assert metrics.score_curve(df, by=["m"]).groupBy("m").agg(F.max("tp")).count() == 3


@pytest.mark.parametrize("label, score", [(None, 0.5), (1.0, None), (1.0, float("nan"))])
def test_areas_refuse_unknown_values(spark, label, score):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.2), (label, score)], "label double, score double")
    for area in (metrics.auc_roc, metrics.auc_pr):
        with pytest.raises(Exception, match="null label"):
            area(df).collect()


def test_threshold_sweep_is_brute_force(spark):
    rng = np.random.default_rng(3)
    labels = (rng.random(500) < 0.3).astype(int)
    scores = np.round(np.clip(0.25 + 0.35 * labels + rng.normal(0, 0.2, 500), 0, 1), 2)
    df = spark.createDataFrame(list(zip(labels.tolist(), scores.tolist())), "label int, score double")

    def weighted_f1(t):
        guess, total = (scores >= t).astype(int), 0.0
        for c in (0, 1):
            hits = ((guess == c) & (labels == c)).sum()
            total += (labels == c).sum() * 2 * hits / max((guess == c).sum() + (labels == c).sum(), 1)
        return total / len(labels)

    expected = [(t, weighted_f1(t)) for t in np.arange(0.30, 0.71, 0.02)]
    sweep = thresholds.threshold_sweep(df)
    for row, (t, f1) in zip(sweep.orderBy("position").collect(), expected):
        assert (row["threshold"], row["f1"]) == (pytest.approx(t), pytest.approx(f1))
    best, best_f1 = 0.5, -1.0
    for t, f1 in expected:
        if f1 > best_f1 + 1e-15:
            best, best_f1 = t, f1
    assert thresholds.best_threshold(sweep).first()["threshold"] == pytest.approx(best)


def test_comparison_table(golden):
    rows = metrics.metrics_rows(golden)
    table = compare_models(rows, rows.withColumn("F1", F.lit(0.0))).collect()
    assert [r["Method"] for r in table][:2] == ["forest", "logistic"]
    assert len(table) == len(GOLDEN)
    assert best_model(rows).first()["Method"] == "forest"
    assert unpivot_metrics(rows.withColumn("F1", F.lit(None).cast("double"))).count() == 3 * len(GOLDEN)
