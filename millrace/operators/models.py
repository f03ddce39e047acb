"""Cross-validated models on Spark ML, and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import store


def assemble(df: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return assembled.withColumn(label, F.col(label).cast("double"))


def random_forest(trees: int = 10, depth: int = 5, seed: int = 0) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def linear_svm(iterations: int = 20) -> LinearSVC:
    return LinearSVC(maxIter=iterations)


def mlp(layers: list[int], iterations: int = 50, seed: int = 0) -> MultilayerPerceptronClassifier:
    """Feed-forward network; ``layers`` lists inputs, hidden units and outputs."""
    return MultilayerPerceptronClassifier(layers=layers, maxIter=iterations, seed=seed)


def cv_predict(df: DataFrame, estimator: Estimator, keep: list[str], folds: int = 5) -> DataFrame:
    """Out-of-fold class of every row: (keep.., fold, label, prediction). ``df`` has a ``fold``.

    The loop is over folds, a fixed number; each fit and each scoring is a distributed job.
    """
    df = store(df, "cv-input")
    parts = None
    for fold in range(folds):
        model = estimator.fit(df.where(F.col("fold") != fold))
        scored = model.transform(df.where(F.col("fold") == fold)).select(*keep, "fold", "label", "prediction")
        parts = scored if parts is None else parts.unionByName(scored)
    return parts


def cv_predict_proba(df: DataFrame, estimator: Estimator, keep: list[str], folds: int = 5) -> DataFrame:
    """Out-of-fold probability of class 1: (keep.., fold, label, probability).

    A model without probabilities gets them from a logistic fit on its raw margin, made on the
    training folds only.
    """
    df = store(df, "cv-input")
    parts = None
    for fold in range(folds):
        train = df.where(F.col("fold") != fold)
        scored = _with_probability(estimator, train, df.where(F.col("fold") == fold))
        scored = scored.select(*keep, "fold", "label", "probability")
        parts = scored if parts is None else parts.unionByName(scored)
    return parts


def _with_probability(estimator: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    model = estimator.fit(train)
    if model.hasParam("probabilityCol"):
        return model.transform(test).withColumn("probability", vector_to_array("probability")[1])
    margin = VectorAssembler(inputCols=["margin"], outputCol="margin_vector")

    def with_margin(df: DataFrame) -> DataFrame:
        scored = model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
        return margin.transform(scored.drop("prediction", "rawPrediction"))

    link = LogisticRegression(featuresCol="margin_vector").fit(with_margin(train))
    return link.transform(with_margin(test)).withColumn("probability", vector_to_array("probability")[1])


def batch_predict(
    df: DataFrame,
    predict: Callable[[np.ndarray], np.ndarray],
    features: list[str],
    keep: list[str],
    batch: int = 1024,
) -> DataFrame:
    """Score a table with a plain function, at most ``batch`` rows per call; one row out per row in.

    ``predict`` maps an (n, features) matrix to n numbers and goes to the workers by value.
    """
    fields = [f for f in df.select(*keep).schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", score double"

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), batch):
                pdf = whole.iloc[start : start + batch]
                yield pdf[keep].assign(score=predict(pdf[features].to_numpy(dtype=float)))

    return df.select(*dict.fromkeys([*keep, *features])).mapInPandas(score, schema)
