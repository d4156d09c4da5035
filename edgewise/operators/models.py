"""The five classifiers of the classification job, on Spark ML.

Each ``*_scores`` function fits on ``train`` and scores ``test``, returning
(u, v, score, label): ``score`` is P(link) (``score_mode='probability'``)
or the 0/1 prediction (``score_mode='label'``, the hard-label scores the
original job reported).
"""

from __future__ import annotations

from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.functions.features import FEATURE_NAMES, NB_FEATURES, SVM_LR_FEATURES
from edgewise.functions.hashing import SEED_SPLIT
from edgewise.operators.features import feature_vectors

ALL_FEATURES = list(range(len(FEATURE_NAMES)))


def make_estimator(kind: str, iterations: int | None = None, seed: int = SEED_SPLIT):
    common = dict(featuresCol="features", labelCol="label_value")
    if kind == "svm":
        return LinearSVC(maxIter=iterations or 30, **common)
    if kind == "logreg":
        return LogisticRegression(maxIter=iterations or 30, **common)
    if kind == "nb":
        return NaiveBayes(modelType="multinomial", **common)
    if kind == "rf":
        return RandomForestClassifier(numTrees=30, maxDepth=4, maxBins=32, impurity="gini",
                                      featureSubsetStrategy="auto", seed=seed, **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=iterations or 10, maxDepth=5, seed=seed, **common)
    raise ValueError(kind)


DEFAULT_INDEXES = {"svm": SVM_LR_FEATURES, "logreg": SVM_LR_FEATURES, "nb": NB_FEATURES,
                   "rf": ALL_FEATURES, "gbt": ALL_FEATURES}


def _score_col(kind: str, score_mode: str):
    if score_mode == "label":
        return F.col("prediction")
    if kind == "svm":
        return vector_to_array("rawPrediction")[1]
    return vector_to_array("probability")[1]


def fit(train: DataFrame, kind: str, indexes=None, iterations: int | None = None):
    idx = DEFAULT_INDEXES[kind] if indexes is None else indexes
    data = feature_vectors(train, idx)
    return make_estimator(kind, iterations).fit(data), idx


def score(model, test: DataFrame, kind: str, indexes, score_mode: str = "probability") -> DataFrame:
    out = model.transform(feature_vectors(test, indexes))
    return out.select("u", "v", _score_col(kind, score_mode).cast("double").alias("score"),
                      F.col("label_value").alias("label"))


def model_scores(train: DataFrame, test: DataFrame, kind: str, indexes=None,
                 iterations: int | None = None, score_mode: str = "probability") -> DataFrame:
    model, idx = fit(train, kind, indexes, iterations)
    return score(model, test, kind, idx, score_mode)


def svm_scores(train, test, **kw):
    return model_scores(train, test, "svm", **kw)


def logreg_scores(train, test, **kw):
    return model_scores(train, test, "logreg", **kw)


def nb_scores(train, test, **kw):
    return model_scores(train, test, "nb", **kw)


def rf_scores(train, test, **kw):
    return model_scores(train, test, "rf", **kw)


def gbt_scores(train, test, **kw):
    return model_scores(train, test, "gbt", **kw)
