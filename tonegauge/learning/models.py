"""Estimators with the regularisation scale of the published models."""

import random
from collections import Counter
from math import exp, log
from threading import Lock
from uuid import uuid4

from pyspark import RDD, SparkContext, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import (
    GBTClassifier, LinearSVCModel, LogisticRegressionModel, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import DenseMatrix, Vector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.learning import linear


class ScaledLinear(Estimator, HasFeaturesCol, HasLabelCol, HasMaxIter, DefaultParamsReadable,
              DefaultParamsWritable):
    """Base for estimators whose penalty is given per data set, not per row.

    ``maxIter`` bounds the passes over the rows, of which an iteration needs one or a few.
    """

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    weight = Param(Params._dummy(), "weight", "weight column, '' for none", TypeConverters.toString)
    tol = Param(Params._dummy(), "tol", "largest entry of the mean gradient at the end", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=1000, weight="", C=1.0,
                         tol=linear.TOLERANCE)

    def _loss(self) -> linear.Loss:
        raise NotImplementedError

    def _model(self, fit: linear.Fit, classes: int):
        raise NotImplementedError

    def fit_groups(self, rows: RDD, stats: dict[int, linear.Stats], many: list[float] | None = None) -> dict[int, list]:
        """For each group of packed rows a model for each C, all in the same passes."""
        many = [self.getOrDefault(self.C)] if many is None else many
        problems = [linear.Problem(g, c) for g in sorted(stats) for c in many]
        fits = linear.solve(rows, problems, self._loss(), self.getOrDefault(self.tol), self.getMaxIter(), stats)
        found: dict[int, list] = {}
        for problem, fit in zip(problems, fits):
            found.setdefault(problem.group, []).append(self._model(fit, max(stats[problem.group].classes, 2)))
        return found

    def _fit_many(self, dataset, many: list[float]) -> list:
        rows = linear.blocks(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault(self.weight))
        try:
            return self.fit_groups(rows, linear.describe(rows), many)[0]
        finally:
            rows.unpersist()

    def _fit(self, dataset):
        return self._fit_many(dataset, [self.getOrDefault(self.C)])[0]


class _ByC:
    """Candidates that differ in C alone are fitted together."""

    def fitMultiple(self, dataset, paramMaps):
        if any({p.name for p in settings} - {"C"} for settings in paramMaps):
            return super().fitMultiple(dataset, paramMaps)
        many = [next(iter(settings.values()), self.getOrDefault(self.C)) for settings in paramMaps]
        return iter(enumerate(self._fit_many(dataset, many)))


def _java(kind: str, *parts):
    """A fitted model of Spark's own kind, which scores and saves like any other."""
    context = SparkContext._active_spark_context
    return JavaParams._new_java_obj(f"org.apache.spark.ml.{kind}", *(
        _py2java(context, p) if isinstance(p, (Vector, DenseMatrix)) else p for p in parts))


def logistic_model(fit: linear.Fit, classes: int, features: str = "features") -> LogisticRegressionModel:
    k, d = fit.weights.shape
    java = _java("classification.LogisticRegressionModel", f"logistic_{uuid4().hex[:12]}",
                 DenseMatrix(k, d, fit.weights.ravel(), True), Vectors.dense(fit.intercept), classes, k > 1)
    return LogisticRegressionModel(java).setFeaturesCol(features)


def svc_model(fit: linear.Fit, classes: int, features: str = "features") -> LinearSVCModel | LogisticRegressionModel:
    """Beyond two classes the largest score wins, and one model holds all scores; it has no probabilities."""
    if classes == 2:
        return LinearSVCModel(_java(
            "classification.LinearSVCModel", f"svc_{uuid4().hex[:12]}", Vectors.dense(fit.weights[0]), float(fit.intercept[0])
        )).setFeaturesCol(features)
    return logistic_model(fit, classes, features).setProbabilityCol("")


class ScaledLogistic(_ByC, ScaledLinear):
    """M5: loss summed over rows times C plus half the squared norm, with a free intercept.

    Features are used as they are; the solver conditions the problem itself.
    """

    @keyword_only
    def __init__(self, C=1.0, maxIter=1000, labelCol="label", featuresCol="features", weight="",
                 tol=linear.TOLERANCE):
        super().__init__()
        self._set(**self._input_kwargs)

    def _loss(self):
        return linear.LOGISTIC

    def _model(self, fit, classes):
        return logistic_model(fit, classes, self.getFeaturesCol())


class ScaledLinearSvc(_ByC, ScaledLinear):
    """M9: linear SVM with the squared hinge loss, one against the rest beyond two classes.

    The intercept is penalised like a weight.
    """

    @keyword_only
    def __init__(self, C=1.0, maxIter=1000, labelCol="label", featuresCol="features", weight="",
                 tol=linear.TOLERANCE):
        super().__init__()
        self._set(**self._input_kwargs)

    def _loss(self):
        return linear.SQUARED_HINGE

    def _model(self, fit, classes):
        return svc_model(fit, classes, self.getFeaturesCol())


class ScaledLinearSvr(_ByC, ScaledLinear):
    """Absolute errors beyond ``epsilon``, summed over rows times C, plus half the squared norm.

    The intercept is penalised like a weight. The loss has corners; they are rounded over a
    width that shrinks to 1e-4, so the result costs at most C x rows x 5e-5 more than the optimum.
    """

    epsilon = Param(Params._dummy(), "epsilon", "errors up to this are free", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, C=1.0, epsilon=0.0, maxIter=1000, labelCol="label", featuresCol="features", weight="",
                 tol=linear.TOLERANCE):
        super().__init__()
        self._setDefault(epsilon=0.0)
        self._set(**self._input_kwargs)

    def _loss(self):
        return linear.epsilon_insensitive(self.getOrDefault(self.epsilon))

    def _model(self, fit, classes):
        return LinearRegressionModel(_java(
            "regression.LinearRegressionModel", f"svr_{uuid4().hex[:12]}", Vectors.dense(fit.weights[0]),
            float(fit.intercept[0]))).setFeaturesCol(self.getFeaturesCol())


class ScaledRidge(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Squared error summed over rows plus alpha times the squared norm.

    Spark halves and averages the error and scales the label by its standard
    deviation, which the penalty must follow.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, alpha=1.0, labelCol="label", featuresCol="features"):
        super().__init__()
        self._setDefault(alpha=1.0, labelCol="label", featuresCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        label = F.col(self.getLabelCol()).cast("double")
        n, std = dataset.agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
        penalty = self.getOrDefault(self.alpha) * (std or 1.0) / max(n, 1)
        return LinearRegression(
            regParam=penalty, elasticNetParam=0.0, standardization=False, solver="normal",
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol()).fit(dataset)


def lasso(alpha: float = 0.001, **columns) -> LinearRegression:
    """Half the mean squared error plus alpha times the absolute norm."""
    return LinearRegression(
        regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=3000, **columns)


def robust_linear(**columns) -> LinearRegression:
    """Linear regression that outliers pull less, by the Huber loss."""
    return LinearRegression(loss="huber", maxIter=300, **columns)


def naive_bayes(**columns) -> NaiveBayes:
    """M6: multinomial, add-one smoothing."""
    return NaiveBayes(modelType="multinomial", smoothing=1.0, **columns)


def random_forest(trees: int = 100, depth: int = 12, **columns) -> RandomForestClassifier:
    """M7: trees are cut at ``depth`` (at most 30 in Spark) instead of growing without limit."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, **columns)


def gradient_boosting(rounds: int = 100, depth: int = 3, rate: float = 0.1, **columns) -> GBTClassifier:
    """M8: binary boosting."""
    return GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED, **columns)


def forest_regressor(trees: int = 40, depth: int = 8, leaf: int = 5, **columns) -> RandomForestRegressor:
    """Every split may use every feature."""
    return RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, featureSubsetStrategy="all",
        seed=SEED, **columns)


def label_indexer(label: str, out: str = "label") -> StringIndexer:
    """Classes coded in alphabetical order."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="error")


def pipeline(stages: list, estimator) -> Pipeline:
    """The vectoriser travels inside the pipeline, so folds do not leak."""
    return Pipeline(stages=[*stages, estimator])


class SharedPipeline(Pipeline):
    """A pipeline whose candidates share the features that their settings have in common.

    ``fitMultiple``, which cross-validation calls once per fold, fits the stages before the
    last once for each of their settings; the models equal those of separate pipelines.
    """

    def fitMultiple(self, dataset, paramMaps):
        *stages, last = self.getStages()
        own = [{p: v for p, v in settings.items() if p.parent == last.uid} for settings in paramMaps]
        shared = [{p: v for p, v in settings.items() if p.parent != last.uid} for settings in paramMaps]
        keys = [frozenset(settings.items()) for settings in shared]
        locks, open_fits, found = {key: Lock() for key in keys}, Counter(keys), {}

        def fit(i: int) -> PipelineModel:
            key = keys[i]
            with locks[key]:
                if key not in found:
                    prepared = Pipeline(stages=stages).fit(dataset, shared[i])
                    found[key] = prepared, prepared.transform(dataset).persist()
            prepared, rows = found[key]
            model = last.fit(rows, own[i])
            with locks[key]:
                open_fits[key] -= 1
                if not open_fits[key]:
                    rows.unpersist()
            return PipelineModel(stages=[*prepared.stages, model])

        return _FitMultipleIterator(fit, len(paramMaps))


def log_uniform(generator: random.Random, low: float, high: float) -> float:
    """One draw whose logarithm is uniform."""
    return exp(generator.uniform(log(low), log(high)))
