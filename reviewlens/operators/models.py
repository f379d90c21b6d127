"""Classifiers of the comparison, trained with Spark ML and scored in one job."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.vectors import to_array
from reviewlens.operators.boosting import fit_gbt
from reviewlens.operators.features import fit_text_features, fit_text_vectors
from reviewlens.operators.labels import fit_label_index
from reviewlens.operators.metrics import auc_roc, binary_metrics, metrics_rows
from reviewlens.operators.stats import add_class_weights
from reviewlens.session import stage

SEED = 42

#: Bytes of binned rows in a partition that a tree learner reads. Boosting reads a partition three times in a task.
#: Each partition also sends a histogram per node, so that smaller ones would make the shuffle grow.
BINNED_BYTES = 320 * 2**20


def lr_unweighted(max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=0.0, elasticNetParam=0.0)


def lr_weighted() -> LogisticRegression:
    return LogisticRegression(
        maxIter=100, regParam=0.01, elasticNetParam=0.0, weightCol="classWeight", family="binomial"
    )


def dt_weighted(max_depth: int = 10, seed: int = SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=max_depth, weightCol="classWeight", seed=seed)


def rf_weighted(num_trees: int = 50, max_depth: int = 10, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, weightCol="classWeight", seed=seed)


def gbt_plain(
    max_iter: int = 50, max_depth: int = 5, seed: int = SEED, weight_col: str | None = None
) -> GBTClassifier:
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=seed)
    return gbt.setWeightCol(weight_col) if weight_col else gbt


def classic_models() -> dict[str, Estimator]:
    """The four compared methods and their parameters."""
    return {
        "Logistic Regression (Baseline)": lr_weighted(),
        "Decision Tree (Weighted)": dt_weighted(),
        "Random Forest (Weighted)": rf_weighted(),
        "Gradient Boosting": gbt_plain(),
    }


def bigram_models(rows: int) -> dict[str, Estimator]:
    """The four methods trained on single words and pairs.

    The penalty is half the squared norm against the *sum* of the losses over ``rows`` rows, on
    unscaled features; MLlib takes the mean of the losses, hence ``1 / rows``.
    """
    balanced = LogisticRegression(
        maxIter=1000, regParam=1.0 / max(rows, 1), standardization=False, weightCol="classWeight"
    )
    return {
        "Logistic Regression (Baseline)": balanced,
        "Decision Tree": DecisionTreeClassifier(maxDepth=10, seed=SEED),
        "Random Forest": RandomForestClassifier(numTrees=50, maxDepth=10, seed=SEED),
        "Gradient Boosting": GBTClassifier(maxIter=50, maxDepth=3, stepSize=0.1, seed=SEED),
    }


def root_split(tree: Model) -> tuple[int, float] | None:
    """Feature and threshold of a fitted tree's first split; None for a single leaf."""
    found = re.search(r"If \(feature (\d+) <= ([-+.\dEe]+)\)", tree.toDebugString)
    return (int(found[1]), float(found[2])) if found else None


def prepare_features(
    train: DataFrame,
    test: DataFrame,
    text: str = "Review",
    sentiment: str = "Sentiment",
    tokenizer: str = "letters",
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Staged train and test tables ``(label, features[, classWeight])`` and the fitted stages.

    The label index (0 = most frequent), the class weights and the features are fitted on ``train``
    once and shared by all models; test rows with an unknown label are skipped.
    """
    indexer = fit_label_index(train, sentiment)
    features, vectors = fit_text_vectors(train, text, tokenizer, [*keep, sentiment])
    fitted = PipelineModel([indexer, features])
    columns = [*keep, "label", "features"]
    weighted = add_class_weights(indexer.transform(vectors).select(*columns))
    return stage(weighted, "train-features"), stage(fitted.transform(test).select(*columns), "test-features"), fitted


def score_models(models: Mapping[str, Model], test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(Method, label, prediction)`` of every model as one table."""
    scored = [
        model.transform(test).select(F.lit(name).alias("Method"), *keep, F.col("label").cast("double"), "prediction")
        for name, model in models.items()
    ]
    together = scored[0]
    for rows in scored[1:]:
        together = together.unionByName(rows)
    return together


def dealt_for(estimator: Estimator, train: DataFrame, binned_bytes: int = BINNED_BYTES) -> DataFrame:
    """``train`` as it is, or for tree learners in partitions whose binned rows stay below ``binned_bytes``.

    Trees hold four bytes for every feature of a row, also of a sparse one, so the files of sparse rows, which are
    small, say nothing about what a task will hold.
    """
    if not isinstance(estimator, (DecisionTreeClassifier, RandomForestClassifier, GBTClassifier)):
        return train
    vector = F.unwrap_udt(estimator.getFeaturesCol())
    width = F.max(F.coalesce(vector["size"], F.size(vector["values"])))
    binned = train.agg((F.count(F.lit(1)) * F.coalesce(width, F.lit(0)) * 4).alias("bytes")).toArrow()["bytes"][0].as_py()
    partitions = math.ceil(binned / binned_bytes)
    return train if partitions < 2 else train.repartition(max(partitions, train.sparkSession.sparkContext.defaultParallelism))


def fit_model(estimator: Estimator, train: DataFrame) -> Model:
    """The fitted model; boosting learns from many rows with wide sparse features by ``boosting.fit_gbt``."""
    model = fit_gbt(estimator, train) if isinstance(estimator, GBTClassifier) else None
    return model or estimator.fit(dealt_for(estimator, train))


def fit_all(estimators: Mapping[str, Estimator], train: DataFrame) -> dict[str, Model]:
    return {name: fit_model(estimator, train) for name, estimator in estimators.items()}


def compare_classic_models(
    train: DataFrame,
    test: DataFrame,
    text: str = "Review",
    sentiment: str = "Sentiment",
    estimators: Mapping[str, Estimator] | None = None,
) -> DataFrame:
    """Weighted metrics and the matrix of each model on the test rows."""
    train_features, test_features, _ = prepare_features(train, test, text, sentiment)
    models = fit_all(estimators or classic_models(), train_features)
    return metrics_rows(score_models(models, test_features))


def bigram_model_suite(
    train: DataFrame, test: DataFrame, text: str = "text", label: str = "label", estimators=None
) -> DataFrame:
    """Class-1 metrics of the models on one- and two-word features; labels are 0 and 1."""
    features = fit_text_features(train, text, "ngrams")
    numeric = F.col(label).cast("double").alias("label")
    train_features = stage(add_class_weights(features.transform(train).select(numeric, "features")), "train-ngrams")
    models = fit_all(estimators or bigram_models(train_features.count()), train_features)
    test_features = stage(features.transform(test).select(numeric, "features"), "test-ngrams")
    return binary_metrics(score_models(models, test_features), by=["Method"])


def lr_on_embeddings(
    train: DataFrame, test: DataFrame, method: str, features: str = "features", label: str = "Sentiment"
) -> DataFrame:
    """Logistic regression on dense vectors: one row of weighted metrics, AUC and the matrix."""
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=10).fit(train)
    scored = stage(
        model.transform(test).select(
            F.lit(method).alias("Method"),
            F.col(label).cast("double").alias("label"),
            "prediction",
            to_array(F.col("rawPrediction"))[1].alias("score"),
        ),
        "embedding-scores",
    )
    return metrics_rows(scored).join(auc_roc(scored, by=["Method"]), "Method", "left").select(
        "Method", "Accuracy", "Precision", "Recall", "F1", F.round("auc", 4).alias("AUC"), "TN", "FP", "FN", "TP"
    )
