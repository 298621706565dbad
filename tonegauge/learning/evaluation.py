"""Model evaluation: macro-F1, comparison tables, tuning, scoring."""

import random
import time
from collections.abc import Callable
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.learning import linear, search, trees
from tonegauge.learning import models as mx
from tonegauge.operators.metrics import macro_scores, regression_scores
from tonegauge.operators.quality import split_valid
from tonegauge.operators.sampling import balanced_weights
from tonegauge.operators.sampling import folds as fold_column
from tonegauge.sources.files import path_exists


class MacroF1(Evaluator):
    """Unweighted mean of the class F1 scores (Spark's own ``f1`` weights them)."""

    def __init__(self, label: str = "label", prediction: str = "prediction", measure: str = "f1_macro"):
        super().__init__()
        self.label, self.prediction, self.measure = label, prediction, measure

    def _evaluate(self, dataset: DataFrame) -> float:
        row = macro_scores(dataset, self.label, self.prediction).first()
        return float(row[self.measure] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def cross_validate(
    estimator: Estimator, train: DataFrame, key: str, k: int, evaluator: Evaluator,
    grid: list[dict] | None = None, stratify: str | None = "label", parallelism: int = 4,
):
    """Cross-validation on repeatable, stratified folds.

    Candidates of a text vectoriser with a linear classifier are fitted together (``search``).
    """
    batch = search.batch(estimator, grid or [{}])
    if batch and isinstance(evaluator, MacroF1) and evaluator.measure == "f1_macro" and stratify in (None, "label"):
        return search.cross_validated(estimator, train, key, k, grid or [{}], batch, stratify)
    folded = fold_column(train, key, k, stratify)
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid or [{}], evaluator=evaluator, numFolds=k,
        foldCol="fold", parallelism=parallelism, seed=SEED).fit(folded)


def side_by_side(
    stages: list, models: dict[str, Estimator], pairs: list[tuple[DataFrame, DataFrame]],
    measure: Callable[[DataFrame], DataFrame], balance: bool = False, parallelism: int = 6,
) -> dict[str, list[tuple[Row, float]]]:
    """For each model a row of ``measure`` and the seconds of its fit, per pair of training and held-out rows.

    The stages learn from a pair's training rows alone, once for all models; the result equals
    separate pipelines.  Linear models of all pairs are fitted in the same passes, whose
    seconds they share, and so are the forests and boosted trees that ``trees`` knows; other
    models are fitted at the same time.  ``balance`` adds the ``weight`` column from the
    classes of the training rows.
    """
    def prepare(pair: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        train, held = pair
        if balance:
            train = balanced_weights(train, "label")
        prepared = Pipeline(stages=[stage.copy() for stage in stages]).fit(train)
        used = [c for c in train.columns if c in ("label", "weight")]
        both = (prepared.transform(train).select("features", *used).persist(),
                prepared.transform(held).select("features", "label").persist())
        for rows in both:
            rows.count()
        return both

    linear_models = {name: model for name, model in models.items() if isinstance(model, mx.ScaledLinear)}

    tree_models = {name: what for name, model in models.items() if (what := trees.spec(model))}

    def packed_pairs(weight: str) -> RDD:
        frames = [train.withColumn("_part", F.lit(i)) for i, (train, _) in enumerate(ready)]
        return linear.blocks(reduce(DataFrame.union, frames), weight=weight, group=F.col("_part"))

    def fit_linear(weight: str) -> list[tuple[str, int, Transformer, float]]:
        packed = packed_pairs(weight)
        # The union has the partitions of every part; a pass wants those of one.
        most = max(packed.getNumPartitions() // len(ready), packed.context.defaultParallelism)
        rows = packed.coalesce(most).persist(StorageLevel.MEMORY_AND_DISK)
        found = []
        try:
            stats = linear.describe(rows)
            packed.unpersist()
            for name, model in linear_models.items():
                if model.getOrDefault("weight") == weight:
                    start = time.time()
                    fitted = model.fit_groups(rows, stats)
                    found += [(name, i, own[0], time.time() - start) for i, own in fitted.items()]
        finally:
            rows.unpersist()
        return found

    def fit_trees(name: str) -> list[tuple[str, int, trees.Fitted, float]]:
        start, packed = time.time(), packed_pairs(tree_models[name].weight)
        try:
            fitted = trees.fit(packed, tree_models[name])
            return [(name, i, model, time.time() - start) for i, model in fitted.items()]
        finally:
            packed.unpersist()

    def fit_alone(name: str, i: int) -> list[tuple[str, int, Transformer, float]]:
        start = time.time()
        return [(name, i, models[name].copy().fit(ready[i][0]), time.time() - start)]

    def scored(item: tuple[str, int, Transformer, float]) -> tuple[str, int, Row, float]:
        name, i, model, seconds = item
        held = ready[i][1]
        guessed = trees.scored(model, held) if isinstance(model, trees.Fitted) else model.transform(held)
        return name, i, measure(guessed).first(), seconds

    def target(job: Callable):
        return inheritable_thread_target(job)()

    with ThreadPool(parallelism) as pool:
        ready = pool.map(inheritable_thread_target(prepare), pairs, 1)
        # Boosting, the last of the models, takes longest.
        jobs = [partial(fit_linear, w) for w in {m.getOrDefault("weight") for m in linear_models.values()}]
        jobs += [partial(fit_trees, name) for name in reversed(models) if name in tree_models]
        jobs += [partial(fit_alone, name, i) for name in reversed(models)
                 if name not in linear_models and name not in tree_models for i in range(len(pairs))]
        fitted = [item for found in pool.map(target, jobs, 1) for item in found]
        measured = pool.map(inheritable_thread_target(scored), fitted, 1)
    for both in ready:
        for rows in both:
            rows.unpersist()
    at = {(name, i): (row, seconds) for name, i, row, seconds in measured}
    return {name: [at[name, i] for i in range(len(pairs))] for name in models}


def _fold_pairs(folded: DataFrame, k: int) -> list[tuple[DataFrame, DataFrame]]:
    return [(folded.where(F.col("fold") != i), folded.where(F.col("fold") == i)) for i in range(k)]


def fold_measures(
    stages: list, models: dict[str, Estimator], df: DataFrame, key: str, k: int,
    measure: Callable[[DataFrame], DataFrame], stratify: str | None = "label", balance: bool = False,
) -> dict[str, list]:
    """One row of ``measure`` per model and fold."""
    folded = fold_column(df, key, k, stratify).persist()
    found = side_by_side(stages, models, _fold_pairs(folded, k), measure, balance)
    folded.unpersist()
    return {name: [row for row, _ in rows] for name, rows in found.items()}


def _mean(values: list[float]) -> float:
    return sum(values) / len(values)


def classifier_measure(df: DataFrame) -> DataFrame:
    return macro_scores(df, "label", "prediction")


def compare_classifiers(
    spark: SparkSession, stages: list, models: dict[str, Estimator], train: DataFrame,
    test: DataFrame, key: str, k: int = 5,
) -> DataFrame:
    """A row per model, best test macro-F1 first."""
    folded = fold_column(train, key, k, "label").persist()
    found = side_by_side(stages, models, [*_fold_pairs(folded, k), (train, test)], classifier_measure)
    folded.unpersist()
    rows = []
    for name, measured in found.items():
        f1 = [row["f1_macro"] for row, _ in measured[:k]]
        scores, seconds = measured[k]
        spread = _mean([(v - _mean(f1)) ** 2 for v in f1]) ** 0.5
        rows.append((name, round(_mean(f1), 4), round(spread, 4), round(scores["accuracy"], 4),
                     round(scores["f1_macro"], 4), round(seconds, 2)))
    return spark.createDataFrame(
        rows, "model string, cv_f1_mean double, cv_f1_std double, test_accuracy double, "
              "test_f1_macro double, train_time_s double",
    ).orderBy(F.col("test_f1_macro").desc(), "model")


def compare_regressors(
    spark: SparkSession, stages: list, models: dict[str, Estimator], df: DataFrame, key: str, k: int = 3,
) -> DataFrame:
    """Mean RMSE and R2 over the folds, smallest RMSE first."""
    folds = fold_measures(
        stages, models, df, key, k, lambda d: regression_scores(d, "label", "prediction"), None)
    rows = [
        (name, round(_mean([r["rmse"] for r in found]), 4), round(_mean([r["r2"] for r in found]), 4))
        for name, found in folds.items()]
    return spark.createDataFrame(rows, "model string, rmse double, r2 double").orderBy("rmse", "model")


def search_table(spark: SparkSession, found, grid: list[dict]) -> DataFrame:
    """One row per candidate with its settings, best first."""
    rows = []
    for settings, mean, std in zip(grid, found.avgMetrics, found.stdMetrics):
        text = ", ".join(sorted(f"{p.name}={v}" for p, v in settings.items()))
        rows.append((text, round(float(mean), 4), round(float(std), 4)))
    return spark.createDataFrame(
        rows, "params string, cv_f1_mean double, cv_f1_std double",
    ).orderBy(F.col("cv_f1_mean").desc(), "params")


def tuning_impact(
    spark: SparkSession, estimator: Estimator, searches: dict[str, list[dict]], train: DataFrame,
    test: DataFrame, key: str, k: int = 5,
) -> DataFrame:
    """Per method the best candidate's cross-validated macro-F1, its macro-F1 on the held-out
    test rows after a refit on all training rows, and the change of that against the first method."""
    every = [settings for grid in searches.values() for settings in grid]
    means, rows, at = cross_validate(estimator, train, key, k, MacroF1(), every).avgMetrics, [], 0
    for name, grid in searches.items():
        own = list(means[at:at + len(grid)])
        at += len(grid)
        f1 = MacroF1().evaluate(estimator.fit(train, grid[own.index(max(own))]).transform(test))
        rows.append((name, round(float(max(own)), 4), round(f1, 4),
                     round(f1 - (rows[0][2] if rows else f1), 4)))
    return spark.createDataFrame(rows, "method string, cv_f1_mean double, test_f1_macro double, delta double")


def random_grid(draws: dict, n: int, seed: int = SEED) -> list[dict]:
    """N settings; each parameter has a list to choose from or a function of the generator."""
    generator = random.Random(seed)
    return [
        {param: draw(generator) if callable(draw) else generator.choice(draw)
         for param, draw in draws.items()}
        for _ in range(n)
    ]


def probability_map(labels: list[str], column: str = "probability", digits: int = 4):
    """Class names to rounded probabilities."""
    values = F.transform(vector_to_array(F.col(column)), lambda p: F.round(p, digits))
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), values)


def class_name(labels: list[str], column: str = "prediction"):
    return F.get(F.array(*[F.lit(x) for x in labels]), F.col(column).cast("int"))


def score(model: Transformer, df: DataFrame, labels: list[str], text: str = "text_content") -> DataFrame:
    """Valid rows with label and probabilities; works on streams too."""
    valid, _ = split_valid(df, text)
    scored = model.transform(valid)
    out = df.columns + ["predicted_label"]
    scored = scored.withColumn("predicted_label", class_name(labels))
    if "probability" in scored.columns:
        scored = scored.withColumn("probabilities", probability_map(labels))
        out.append("probabilities")
    return scored.select(*out)


def compare_labels(scored: DataFrame, reference: DataFrame, key: str, label: str = "reference_label") -> DataFrame:
    """Both labels of each text and whether they agree."""
    return scored.join(reference.select(key, label), key).withColumn(
        "agree", F.col("predicted_label").eqNullSafe(F.col(label)))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_train(path: str | None, train) -> PipelineModel:
    """The saved pipeline if there is one, otherwise train it (and save it)."""
    if path and path_exists(SparkSession.active(), f"{path}/metadata"):
        return PipelineModel.load(path)
    model = train()
    if path:
        save_model(model, path)
    return model


def class_terms(spark: SparkSession, model: PipelineModel, labels: list[str], n: int = 10) -> DataFrame:
    """Terms with the largest coefficients of each class (classes x n rows).

    Coefficients and vocabulary are model parameters on the driver already.
    """
    stages = [part for stage in model.stages for part in getattr(stage, "stages", [stage])]
    vocabulary = next(s.vocabulary for s in stages if hasattr(s, "vocabulary"))
    last = model.stages[-1]
    if last.numClasses == 2:
        weights = last.coefficients.toArray()
        per_class = {labels[0]: -weights, labels[1]: weights}
    else:
        per_class = dict(zip(labels, last.coefficientMatrix.toArray()))
    rows = []
    for label, values in per_class.items():
        order = sorted(range(len(vocabulary)), key=lambda i: (-values[i], vocabulary[i]))[:n]
        rows += [(label, rank, vocabulary[i], float(values[i])) for rank, i in enumerate(order, 1)]
    return spark.createDataFrame(rows, "class string, rank int, term string, weight double")
