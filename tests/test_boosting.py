"""Boosted trees on sparse features against Spark's learner."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlens.operators import boosting, imbalance, models


def sparse_rows(spark, rows=500, width=40, negative=False):
    rng = np.random.default_rng(5)
    made = []
    for _ in range(rows):
        at = np.flatnonzero(rng.random(width) < 0.15)
        values = rng.normal(size=len(at))
        values = values if negative else abs(values)
        label = float(values[at < 8].sum() + rng.normal(0, 0.5) > (0.3 if negative else 1.0))
        made.append((label, Vectors.sparse(width, at, values), float(rng.integers(1, 5)) / 2))
    return spark.createDataFrame(made, ["label", "features", "classWeight"]).repartition(3).persist()


def splits_of(model):
    return [line for line in model.toDebugString.split("\n") if "If (" in line]


@pytest.fixture
def always(monkeypatch):
    monkeypatch.setattr(boosting, "SPARK_BYTES", 0)


@pytest.mark.parametrize("negative", [False, True])
def test_same_trees_as_spark(spark, always, monkeypatch, negative):
    """With several blocks in a task, several ranges of bins, and fewer nodes in a job than a level has.

    Leaves of nine rows and more have no two splits of equal gain, which either learner chooses from by rounding.
    """
    for name, value in {"BLOCK_ROWS": 130, "RANGE_CELLS": 200, "SLICE_ENTRIES": 300, "HISTOGRAM_BYTES": 24 * 3000}.items():
        monkeypatch.setattr(boosting, name, value)
    df = sparse_rows(spark, negative=negative)
    weighted = models.gbt_plain(max_iter=3, max_depth=3, weight_col="classWeight").setMaxBins(11).setMinInfoGain(0.01)
    for estimator in (models.gbt_plain(max_iter=3, max_depth=2), weighted):
        estimator.setMinInstancesPerNode(9)
        own, spark_model = boosting.fit_gbt(estimator, df), estimator.fit(df)
        assert splits_of(own) == splits_of(spark_model) != []
        assert own.treeWeights == spark_model.treeWeights and own.totalNumNodes == spark_model.totalNumNodes
        assert own.getMaxDepth() == estimator.getMaxDepth() and own.numFeatures == 40
        assert own.featureImportances.toArray() == pytest.approx(spark_model.featureImportances.toArray(), abs=1e-9)
        margins = [[r[0][1] for r in m.transform(df).select("rawPrediction").collect()] for m in (own, spark_model)]
        assert margins[0] == pytest.approx(margins[1], abs=1e-9)
        roots = [m.trees[1]._java_obj.rootNode() for m in (own, spark_model)]
        assert roots[0].impurity() == pytest.approx(roots[1].impurity())


def test_rows_of_one_class(spark, always):
    df = sparse_rows(spark, 60).withColumn("label", F.lit(1.0))
    estimator = models.gbt_plain(max_iter=2)
    own, spark_model = boosting.fit_gbt(estimator, df), estimator.fit(df)
    assert own.trees[0].numNodes == 1
    margins = [[r[0][1] for r in m.transform(df).select("rawPrediction").collect()] for m in (own, spark_model)]
    assert margins[0] == pytest.approx(margins[1], abs=1e-9)


def test_what_is_left_to_spark(spark, always, monkeypatch):
    df = sparse_rows(spark, 60)
    plain = models.gbt_plain(max_iter=1)
    for frame in (
        df.withColumn("label", F.lit(2.0)),
        df.withColumn("label", F.lit(None).cast("double")),
        df.limit(0),
        spark.createDataFrame([(1.0, Vectors.dense(1.0, 2.0)), (0.0, Vectors.dense(2.0, 1.0))], ["label", "features"]),
        spark.createDataFrame([(1.0, Vectors.sparse(9, [1], [float("nan")]))], ["label", "features"]),
    ):
        assert boosting.fit_gbt(plain, frame) is None
    assert boosting.fit_gbt(models.gbt_plain(max_iter=1, weight_col="w"), df.withColumn("w", F.lit(-1.0))) is None
    assert boosting.fit_gbt(GBTClassifier(subsamplingRate=0.5), df) is None
    monkeypatch.setattr(boosting, "SPARK_BYTES", 60 * 40 * 4)
    assert boosting.fit_gbt(plain, df) is None


def test_wide_sparse_rows_do_not_reach_sparks_booster(spark, always, monkeypatch):
    """Its work and memory grow with every feature of every row."""
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *_: pytest.fail("learned on dense rows"))
    df = sparse_rows(spark, 80)
    fitted = models.fit_all({"gbt": models.gbt_plain(max_iter=1, max_depth=1)}, df)["gbt"]
    assert models.root_split(fitted.trees[0])
    monkeypatch.setattr(imbalance, "RandomForestClassifier", lambda **_: models.rf_weighted(num_trees=2, max_depth=2))
    monkeypatch.setattr(imbalance, "GBTClassifier", lambda **_: models.gbt_plain(max_iter=1, max_depth=2))
    votes = imbalance.vote_probabilities(df, df)
    assert votes.count() == 80 and votes.filter("gbt_pos_prob between 0 and 1").count() == 80
