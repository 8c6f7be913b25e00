"""Base classifiers on ``pyspark.ml``, and scorers that turn a fitted one into columns."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import (
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.functions.expressions import logistic
from evenhand.operators.newton import penalised_gradient

BASE_ESTIMATORS = ("LogisticRegression", "RandomForest")
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LinearScorer:
    """A fitted linear model as a column expression; no coefficients mean a constant model.

    ``attempts`` and ``gradient`` (the largest part of that of the penalised loss, where it was looked at) tell how it was fitted.
    """

    intercept: float
    coefficients: tuple[float, ...]
    converged: bool = True
    attempts: int = field(default=1, compare=False)
    gradient: float | None = field(default=None, compare=False)

    def margin(self, names: list[str]) -> Column:
        z = F.lit(float(self.intercept))
        for name, weight in zip(names, self.coefficients, strict=False):
            if weight:
                z = z + F.lit(float(weight)) * F.col(name)
        return z

    def with_scores(self, df: DataFrame, names: list[str], hard: str, probability: str | None = None) -> DataFrame:
        z = self.margin(names)
        out = df.withColumn(hard, (z > 0).cast("int"))
        return out if probability is None else out.withColumn(probability, logistic(z))


@dataclass(frozen=True)
class ConstantScorer:
    """Always the same class: the result of training on a single class."""

    value: int

    def with_scores(self, df: DataFrame, names: list[str], hard: str, probability: str | None = None) -> DataFrame:
        out = df.withColumn(hard, F.lit(self.value))
        return out if probability is None else out.withColumn(probability, F.lit(float(self.value)))


@dataclass(frozen=True)
class ForestScorer:
    model: RandomForestClassificationModel

    def with_scores(self, df: DataFrame, names: list[str], hard: str, probability: str | None = None) -> DataFrame:
        vector, raw, prob = "__v", "__raw", "__prob"
        m = self.model.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol("__p")
        assembled = VectorAssembler(inputCols=names, outputCol=vector, handleInvalid="error").transform(df)
        out = m.transform(assembled).withColumn(hard, F.col("__p").cast("int"))
        if probability is not None:
            out = out.withColumn(probability, vector_to_array(prob)[1])
        return out.drop(vector, raw, prob, "__p")


@dataclass(frozen=True)
class BaseLearner:
    """Settings of the underlying estimator.

    The penalty follows the convention of inverse strength ``c``: with a mean loss over weight
    ``w`` in total, lambda is ``1 / (c * w)``. A fit that uses up its iterations has converged if no part of the
    gradient exceeds ``tol``. Otherwise ``fit`` retries with twice the iterations and ten times the penalty. A last try that runs out as well is an error
    with ``on_unconverged="raise"``; otherwise it is logged and the scorer says so.
    """

    kind: str = "LogisticRegression"
    c: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-6
    max_retries: int = 3
    num_trees: int = 20
    max_depth: int = 5
    seed: int = 42
    aggregation_depth: int = 2
    on_unconverged: str = "warn"

    def __post_init__(self) -> None:
        if self.kind not in BASE_ESTIMATORS:
            raise ValueError(f"Unknown base estimator: {self.kind}; choose from {BASE_ESTIMATORS}")
        if self.max_retries < 1:
            raise ValueError("max_retries must be at least 1")
        if self.on_unconverged not in ("warn", "raise"):
            raise ValueError(f"unconverged fits warn or raise; not {self.on_unconverged!r}")

    def fit(self, df: DataFrame, names: list[str], label: str, total_weight: float, weight: str | None = None):
        """Fit on prepared feature columns; ``df`` should be persisted by the caller."""
        if self.kind == "RandomForest":
            return self._fit_forest(df, names, label, weight)
        data = VectorAssembler(inputCols=names, outputCol="__features", handleInvalid="error").transform(df)
        max_iter, penalty = self.max_iter, 1.0 / (self.c * total_weight)
        for attempt in range(1, self.max_retries + 1):
            estimator = LogisticRegression(
                featuresCol="__features",
                labelCol=label,
                maxIter=max_iter,
                regParam=penalty,
                elasticNetParam=0.0,
                standardization=False,
                tol=self.tol,
                family="binomial",
                aggregationDepth=self.aggregation_depth,
            )
            if weight is not None:
                estimator = estimator.setWeightCol(weight)
            model = estimator.fit(data)
            converged, gradient = model.summary.totalIterations < max_iter, None
            if not converged:
                point = np.array([*model.coefficients, model.intercept])
                weights = F.lit(1.0) if weight is None else F.col(weight)
                gradient = penalised_gradient(df, names, F.col(label), weights, total_weight, penalty, point)
                converged = gradient <= self.tol
            if converged:
                break
            log.warning("no convergence in %d iterations, attempt %d", max_iter, attempt)
            if attempt < self.max_retries:
                max_iter, penalty = max_iter * 2, penalty * 10
        if not converged and self.on_unconverged == "raise":
            raise RuntimeError(f"no convergence in {max_iter} iterations")
        coefficients = tuple(float(w) for w in model.coefficients)
        return LinearScorer(float(model.intercept), coefficients, converged, attempt, gradient)

    def _fit_forest(self, df: DataFrame, names: list[str], label: str, weight: str | None):
        data = VectorAssembler(inputCols=names, outputCol="__features", handleInvalid="error").transform(df)
        estimator = RandomForestClassifier(
            featuresCol="__features",
            labelCol=label,
            numTrees=self.num_trees,
            maxDepth=self.max_depth,
            seed=self.seed,
        )
        if weight is not None:
            estimator = estimator.setWeightCol(weight)
        return ForestScorer(estimator.fit(data))
