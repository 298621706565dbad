"""The modelling tasks, each a function of prepared DataFrames."""

from collections.abc import Callable

from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.functions.coerce import flag
from tonegauge.learning import features as fx
from tonegauge.learning import linear
from tonegauge.learning import models as mx
from tonegauge.learning.evaluation import class_name
from tonegauge.operators import metrics, posts, sampling


def coded(df: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """Adds the numeric ``label``; the class names come back in code order."""
    known = df.where(F.col(label).isNotNull())
    indexer = mx.label_indexer(label).fit(known)
    return indexer.transform(known), list(indexer.labels)


def split(df: DataFrame, key: str, label: str = "label", test: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows."""
    marked = sampling.split_rows(df, key, label, test, SEED)
    return marked.where("NOT is_test"), marked.where("is_test")


def text_models(iterations: int = 100) -> dict[str, Estimator]:
    """Logistic regression, naive Bayes and linear SVM."""
    return {
        "logistic": mx.ScaledLogistic(maxIter=iterations),
        "naive_bayes": mx.naive_bayes(),
        "linear_svc": mx.ScaledLinearSvc(maxIter=iterations),
    }


def tone_models(trees: int = 100, iterations: int = 100) -> dict[str, Estimator]:
    """M5-M7: the three families compared for tone."""
    return {
        "logistic": mx.ScaledLogistic(maxIter=iterations),
        "naive_bayes": mx.naive_bayes(),
        "random_forest": mx.random_forest(trees=trees, depth=8),
    }


def weighted_models(trees: int = 120, rounds: int = 100, iterations: int = 100) -> dict[str, Estimator]:
    """Two-class models, balanced by the ``weight`` column but for boosting."""
    return {
        "logistic": mx.ScaledLogistic(weight="weight", maxIter=iterations),
        "linear_svc": mx.ScaledLinearSvc(weight="weight", maxIter=iterations),
        "random_forest": mx.random_forest(trees=trees, depth=10, weightCol="weight"),
        "gradient_boosting": mx.gradient_boosting(rounds=rounds),
    }


def engagement_models(trees: int = 40) -> dict[str, Estimator]:
    """Regressors of the log engagement."""
    return {
        "ridge": mx.ScaledRidge(),
        "lasso": mx.lasso(),
        "linear_svr": mx.ScaledLinearSvr(),
        "robust_linear": mx.robust_linear(),
        "random_forest": mx.forest_regressor(trees=trees),
    }


def contrast(spark: SparkSession, tasks: dict[str, DataFrame], key: str, model: Callable[[], Estimator]) -> DataFrame:
    """The same method on several tasks, against majority and random baselines."""
    rows = []
    for name, df in tasks.items():
        train, test = split(df, key)
        fitted = model().fit(train)
        f1 = metrics.macro_scores(fitted.transform(test), "label", "prediction")
        majority = test.crossJoin(F.broadcast(sampling.majority_class(train, "label")))  # one row
        guess = sampling.random_by_prior(train, test, key, "label")
        scores = [f1, metrics.macro_scores(majority, "label", "prediction"),
                  metrics.macro_scores(guess, "label", "prediction")]
        values = [s.first() for s in scores]
        rows.append((name, values[0]["n"], round(values[0]["accuracy"], 4),
                     *[round(v["f1_macro"], 4) for v in values],
                     values[0]["f1_macro"] - values[2]["f1_macro"] > 0.05))
    return spark.createDataFrame(
        rows, "task string, n_test bigint, accuracy double, f1_macro double, "
              "f1_majority double, f1_random double, has_signal boolean")


def manual_ablation(train: DataFrame, test: DataFrame, text: str, manual: list[str]) -> dict[str, float]:
    """Macro-F1 of logistic regression on the text, on text and hand-made features, and on these alone.

    The features are made once, side by side; a scenario's are columns of theirs, equal to those of
    its own pipeline. Both models with text share their passes; the narrow one, which takes many
    more of them, reads its own columns only.
    """
    prepared = Pipeline(stages=fx.text_with_manual_stages(text, manual)).fit(train)
    middle = len(next(s.vocabulary for s in prepared.stages[0].stages if hasattr(s, "vocabulary")))
    scenarios = {"text": (0, middle), "text_and_manual": (0, middle + len(manual)),
                 "manual": (middle, middle + len(manual))}

    def only(packed: RDD, names: list[str]) -> RDD:
        spans = [scenarios[name] for name in names]
        return packed.flatMap(lambda block: [
            linear.columns_of(block, i, *span) for i, span in enumerate(spans)]).persist(StorageLevel.MEMORY_AND_DISK)

    model, fits, classes = mx.ScaledLogistic(), {}, 2
    packed = linear.blocks(prepared.transform(train))
    for names in (["manual"], ["text", "text_and_manual"]):
        rows = only(packed, names)
        stats = linear.describe(rows)
        if len(fits) + len(names) == len(scenarios):
            packed.unpersist()
        found = linear.solve(rows, [linear.Problem(i, model.getOrDefault("C")) for i in range(len(names))],
                             linear.LOGISTIC, model.getOrDefault("tol"), model.getMaxIter(), stats)
        fits |= dict(zip(names, found))
        classes = max(classes, *(s.classes for s in stats.values()))
        rows.unpersist()
    packed = linear.blocks(prepared.transform(test))
    held = only(packed, list(scenarios))
    classes = max(classes, *(s.classes for s in linear.describe(held).values()))
    packed.unpersist()
    counts = linear.confusion(held, [(i, fits[name]) for i, name in enumerate(scenarios)], classes)
    held.unpersist()
    return {name: linear.macro_f1(table) for name, table in zip(scenarios, counts)}


def predictions(model: PipelineModel, df: DataFrame, key: str, labels: list[str]) -> DataFrame:
    scored = model.transform(df)
    return scored.select(
        key, class_name(labels, "label").alias("label"), class_name(labels).alias("prediction"))


def success_table(df: DataFrame) -> DataFrame:
    """Posts with leakage-free features and the authentic-success label."""
    featured = (
        posts.add_text_counts(posts.add_calendar(posts.parse_timestamp(df)))
        .transform(posts.flag_authentic_success, organic_only=False, out="authentic_success")
    )
    return featured.withColumn("label", F.col("authentic_success").cast("double"))


def coherence_table(df: DataFrame) -> DataFrame:
    """Organic posts with context features, coherence and log engagement."""
    featured = posts.organic(
        posts.add_leakage_free_features(df).withColumn("es_fake", flag(F.col("engagement_rate") > 1)),
        "es_fake")
    return featured.withColumns({
        "label": F.col("coherencia_sentimiento").cast("double"),
        "log_engagement": posts.natural_log_engagement(F.col("engagement_rate")),
    })


SUCCESS_CATEGORIES = ["platform", "brand_name", "campaign_phase", "language", "day_of_week"]
SUCCESS_NUMBERS = ["hour", "month", "text_len", "word_count", "hashtag_count", "mention_count",
                   "has_question", "has_exclamation"]
