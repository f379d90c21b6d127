"""Trained models: properties that hold whatever the data."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from reviewlens.functions.vectors import margin_to_probability, positive_probability
from reviewlens.operators import imbalance, models, splits, tuning
from reviewlens.operators.stats import add_class_weights
from workload import fixtures as fx
from workload import queries


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)).round(3)
    y = ((x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.7, 400)) > 0.8).astype(float)
    rows = [(i, float(y[i]), x[i].tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, label double, a array<double>").coalesce(2)
    return add_class_weights(df.select("doc_id", "label", array_to_vector("a").alias("features"))).persist()


def arrays(df):
    rows = df.collect()
    column = lambda name: np.array([r[name] for r in rows])
    return np.array([r["features"].toArray() for r in rows]), column("label"), column("classWeight")


def test_logistic_gradient_vanishes(small):
    estimator = models.lr_weighted().setTol(1e-10).setStandardization(False)
    model = estimator.fit(small)
    x, y, w = arrays(small)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    gradient = (w * (p - y)) @ x / w.sum() + 0.01 * model.coefficients.toArray()
    assert np.abs(gradient).max() < 1e-4 and abs((w * (p - y)).sum() / w.sum()) < 1e-4


def test_stump_is_the_best_split(small):
    model = DecisionTreeClassifier(maxDepth=1, maxBins=400, weightCol="classWeight").fit(small)
    x, y, w = arrays(small)

    def gini(part):
        total = w[part].sum()
        share = w[part][y[part] == 1].sum() / total if total else 0
        return total * 2 * share * (1 - share)

    best = min(gini(x[:, j] <= c) + gini(x[:, j] > c) for j in range(3) for c in np.unique(x[:, j])[:-1])
    rows = model.transform(small).select("label", "prediction", "probability", "classWeight", "features").collect()
    leaves = {}
    for r in rows:
        leaves.setdefault(tuple(r["probability"]), []).append(r)
    assert len(leaves) == 2
    got = 0.0
    for members in leaves.values():
        total = sum(r["classWeight"] for r in members)
        share = sum(r["classWeight"] for r in members if r["label"] == 1) / total
        got += total * 2 * share * (1 - share)
    assert got == pytest.approx(best, rel=1e-6)


@pytest.mark.parametrize(
    "make",
    [
        lambda: RandomForestClassifier(numTrees=5, seed=42),
        lambda: GBTClassifier(maxIter=4, seed=42, weightCol="classWeight"),
    ],
)
def test_refit_gives_the_same_model(small, make):
    estimator = make()
    first, second = estimator.fit(small).transform(small), estimator.fit(small).transform(small)
    probabilities = [r["probability"].toArray() for r in first.orderBy("doc_id").collect()]
    again = [r["probability"].toArray() for r in second.orderBy("doc_id").collect()]
    assert np.allclose(probabilities, again) and np.allclose(np.sum(probabilities, axis=1), 1.0)


def test_boosted_probability_formulas(small):
    scored = GBTClassifier(maxIter=3, seed=1).fit(small).transform(small).select(
        positive_probability(F.col("probability")).alias("own"),
        margin_to_probability(F.col("rawPrediction")).alias("single"),
        margin_to_probability(F.col("rawPrediction"), mllib_scale=True).alias("double"),
    )
    row = scored.agg(
        F.max(F.abs(F.col("own") - F.col("double"))), F.max(F.abs(F.col("own") - F.col("single")))
    ).first()
    assert row[0] < 1e-12 < row[1]


def test_cross_validation_takes_the_best(small):
    folded = tuning.stratified_fold(small, ["doc_id"], folds=3).persist()
    tree = DecisionTreeClassifier(weightCol="classWeight", seed=42)
    grid = {"maxDepth": [1, 4], "minInstancesPerNode": [1, 20]}
    tuned = tuning.cross_validate(tree, grid, tuning.class_score("f1"), folded, folds=3)
    scores = tuned.scores.collect()
    best = max(scores, key=lambda r: (r["score"], -r["candidate"]))
    assert len(scores) == 4 and [r["candidate"] for r in scores if r["best"]] == [best["candidate"]]
    params = {r["param"]: r["value"] for r in tuning.best_params(tuned).filter("tuned").collect()}
    assert set(params) == set(grid) and all(f"{n}={params[n]}" in best["params"] for n in grid)
    again = tuning.cross_validate(tree, grid, tuning.class_score("f1"), folded.repartition(5), folds=3)
    assert np.allclose([r["score"] for r in scores], [r["score"] for r in again.scores.collect()])
    with pytest.raises(ValueError):
        tuning.cross_validate(tree, grid, tuning.class_score("f1"), folded, folds=4)


def test_scores_are_those_of_the_evaluator(small):
    """Spark ML's cross-validation over the same folds gives the same means."""
    folded = tuning.stratified_fold(small, ["doc_id"], folds=3).persist()
    tree = DecisionTreeClassifier(weightCol="classWeight", seed=42, maxDepth=2)
    evaluator = MulticlassClassificationEvaluator(metricName="recallByLabel", metricLabel=1.0)
    grid = ParamGridBuilder().addGrid(tree.minInstancesPerNode, [1, 30]).build()
    plain = CrossValidator(estimator=tree, estimatorParamMaps=grid, evaluator=evaluator, numFolds=3, foldCol="fold").fit(folded)
    tuned = tuning.cross_validate(tree, {"minInstancesPerNode": [1, 30]}, tuning.class_score("recall"), folded, folds=3)
    assert np.allclose(plain.avgMetrics, [r["score"] for r in tuned.scores.orderBy("candidate").collect()])


def test_every_class_in_every_fold(spark):
    rows = [(i, float(i < 7)) for i in range(2000)] + [(5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, label double").repartition(7)
    got = tuning.stratified_fold(df, ["doc_id"])
    counts = {(r["label"], r["fold"]): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    assert sorted(counts[1.0, f] for f in range(5)) == [1, 1, 1, 2, 2]
    assert {counts[0.0, f] for f in range(5)} <= {398, 399} and sum(counts[None, f] for f in range(5) if (None, f) in counts) == 1
    again = tuning.stratified_fold(df.repartition(3), ["doc_id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert tuning.stratified_fold(df.filter("doc_id < 0"), ["doc_id"]).count() == 0


def test_tuning_survives_a_rare_class(spark):
    """Text features, 30 rows of which six are of class 1; a class that is never predicted scores zero."""
    rows = [(i, float(i % 5 == 0), Vectors.sparse(40, [i, 39], [1.0, 1.0]), 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features", "classWeight"])
    tuned = tuning.cv_decision_tree(tuning.stratified_fold(df, ["doc_id"]))
    assert [tuple(r) for r in tuned.scores.select("candidate", "score").collect()] == [(0, 0.0)]
    fewer = tuning.cv_gbt(tuning.add_fold(df.filter("doc_id <> 0"), ["doc_id"], 3), {"maxIter": [2]}, folds=3)
    assert 0.0 <= fewer.scores.first()["score"] <= 1.0


def test_text_models(spark, sf):
    train, test = fx.train_test(spark, sf)
    rows = {r["Method"]: r for r in models.compare_classic_models(train, test, estimators=few()).collect()}
    assert set(rows) == set(few())
    assert all(r["TN"] + r["FP"] + r["FN"] + r["TP"] == test.count() for r in rows.values())


def few():
    return {"lr": models.lr_weighted(), "tree": models.dt_weighted(max_depth=3)}


def test_bigram_suite(spark, sf):
    divided = fx.payload_reviews(spark, sf)
    estimators = {"tree": models.dt_weighted(max_depth=2)}
    rows = models.bigram_model_suite(splits.part(divided, "train"), splits.part(divided, "test"), estimators=estimators)
    assert rows.first()["Method"] == "tree"
    assert models.bigram_models(10)["Logistic Regression (Baseline)"].getRegParam() == 0.1


def test_soft_vote(spark):
    df = spark.createDataFrame([(0.9, 0.2, 0.5), (0.5, 0.5, 0.5), (0.1, 0.9, 0.1)], "rf double, gbt double, lr double")
    got = imbalance.soft_vote(df, {"rf": "rf", "gbt": "gbt", "lr": "lr"}).collect()
    assert [r["ensemble_prob"] for r in got] == pytest.approx([0.52, 0.5, 0.42])
    assert [r["prediction"] for r in got] == [1, 1, 0]


def test_threshold_moving(small):
    train, test = small.filter("doc_id < 300"), small.filter("doc_id >= 300")
    row = imbalance.threshold_moving(train, test).first()
    assert row["TN"] + row["FP"] + row["FN"] + row["TP"] == 100
    assert any(row["Threshold"] == pytest.approx(t) for t in np.arange(0.30, 0.71, 0.02))


def test_smote_lr(small):
    row = imbalance.smote_lr(small.filter("doc_id < 300"), small.filter("doc_id >= 300")).first()
    assert row["Method"] == "Balanced by synthetic rows" and row["Accuracy"] > 0.6


def test_pseudo_label(spark, sf):
    train, test = fx.aligned_train_test(spark, sf)
    row = imbalance.pseudo_label(train, test, high=0.6, low=0.4).first()
    assert row["augmented_rows"] == row["labeled_rows"] + row["pseudo_positive"] + row["pseudo_negative"]
    assert 0 < row["pseudo_positive"] + row["pseudo_negative"] <= train.count() - row["labeled_rows"]
    never = imbalance.pseudo_label(train, test, high=2.0, low=-1.0).first()
    assert never["augmented_rows"] == never["labeled_rows"]


def test_tree_rows_are_dealt_by_binned_size(spark):
    wide = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    rows = wide.withColumn("features", array_to_vector(F.array_repeat(F.col("label"), 50)))
    # 200 rows of 50 features are 40,000 bytes when binned.
    dealt = models.dealt_for(models.dt_weighted(), rows, binned_bytes=2000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 20
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    for same in (models.dealt_for(models.lr_unweighted(), rows, 2000), models.dealt_for(models.gbt_plain(), rows)):
        assert same is rows
    assert models.dealt_for(models.gbt_plain(), rows.limit(0), 2000).count() == 0


def test_final_comparison_divides_the_reviews_once(spark, sf, monkeypatch):
    calls, divide = [], fx.aligned_train_test
    monkeypatch.setattr(fx, "aligned_train_test", lambda *given: calls.append(given) or divide(*given))
    for way in ("smote_lr", "weighted_ensemble", "threshold_moving", "pseudo_label"):
        right = lambda _, test, way=way: imbalance.named_metrics(test.select("label", F.col("label").alias("prediction")), way)
        monkeypatch.setattr(imbalance, way, right)
    assert queries.final_comparison(spark, sf).count() == 5
    assert len(calls) == 1
