"""The batched linear solver: optima by brute force, shared passes, and the search that uses it."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonegauge.learning import evaluation, linear
from tonegauge.learning import features as fx
from tonegauge.learning import models as mx
from tonegauge.learning import search

N, D, K = 300, 8, 3


@pytest.fixture(scope="module")
def data():
    """Columns of very different size, classes by a noisy linear rule, weights, two groups."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(N, D)) * (rng.random((N, D)) < 0.4) * np.logspace(0, -2, D)
    y = (x @ rng.normal(size=(D, K)) * 5 + rng.normal(size=(N, K))).argmax(axis=1)
    return x, y, rng.random(N) + 0.5, np.arange(N) % 2


@pytest.fixture(scope="module")
def rows(spark, data):
    def vector(i):  # dense and sparse, an empty one among them
        return Vectors.dense(data[0][i]) if i % 3 == 0 else Vectors.sparse(
            D, [(int(j), float(data[0][i, j])) for j in np.flatnonzero(data[0][i])])

    df = spark.createDataFrame(
        [(int(data[3][i]), vector(i), float(data[1][i]), float(data[2][i])) for i in range(N)],
        ["part", "features", "label", "w"])
    return df.repartition(3)


def logistic(w, b, x, y, s, c):
    z = x @ w.T + b
    z -= z.max(axis=1, keepdims=True)
    return c * (s * (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y])).sum() + (w * w).sum() / 2


def hinge(w, b, x, y, s, c):
    sign = np.where(y[:, None] == np.arange(K), 1, -1)
    return c * (s[:, None] * np.maximum(0, 1 - sign * (x @ w.T + b)) ** 2).sum() + ((w * w).sum() + (b * b).sum()) / 2


@pytest.mark.parametrize("loss,cost", [(linear.LOGISTIC, logistic), (linear.SQUARED_HINGE, hinge)])
def test_groups_and_penalties_reach_their_optimum_together(rows, data, loss, cost):
    x, y, s, part = data
    packed = linear.blocks(rows, weight="w", group=F.col("part"))
    problems = [linear.Problem(0, 0.1), linear.Problem(1, 1.0), linear.Problem(1, 100.0)]
    fits = linear.solve(packed, problems, loss, tolerance=1e-9)
    alone, = linear.solve(packed, problems[1:2], loss, tolerance=1e-9)
    assert np.allclose(alone.weights, fits[1].weights, atol=1e-6)
    rng = np.random.default_rng(1)
    for p, fit in zip(problems, fits):
        assert fit.gradient <= 1e-9 and fit.passes < 200
        own = [v[part == p.group] for v in (x, y, s)]
        least = cost(fit.weights, fit.intercept, *own, p.C)
        for size in (1e-1, 1e-3):
            moved = [cost(fit.weights + size * rng.normal(size=fit.weights.shape),
                          fit.intercept + size * rng.normal(size=K), *own, p.C) for _ in range(50)]
            assert min(moved) > least
    counts = linear.confusion(packed, list(zip((0, 1, 1), fits)), K)
    for p, fit, table in zip(problems, fits, counts):
        guess = (x[part == p.group] @ fit.weights.T + fit.intercept).argmax(axis=1)
        expected = np.zeros((K, K), int)
        np.add.at(expected, (y[part == p.group], guess), 1)
        assert (table == expected).all()
    packed.unpersist()


def test_products_of_a_block_need_no_sort(rows, data, monkeypatch):
    """A pass multiplies rows as they are packed; sorting entries by column took most of its time."""
    packed = linear.blocks(rows, weight="w", group=F.col("part")).collect()
    dense = linear.Block(0, np.arange(0, 13, 3), np.tile(np.arange(3, dtype=np.int32), 4), np.arange(12.0),
                         np.zeros(4), np.ones(4), 3)
    monkeypatch.setattr(np, "argsort", None)
    for block in (*packed, dense):
        x = np.zeros((len(block.target), block.width))
        x[block.rows, block.columns] = block.values
        w, r = np.random.default_rng(2).normal(size=(2, max(x.shape), 3))
        assert np.allclose(block.dot(w[:block.width]), x @ w[:block.width])
        assert np.allclose(block.back(r[:len(x)]), x.T @ r[:len(x)])
    assert dense.full and not any(b.full for b in packed)


def test_models_of_spark_score_the_fits(rows, data):
    x, y, s, _ = data
    for estimator, loss in ((mx.ScaledLogistic(weight="w", tol=1e-8), linear.LOGISTIC),
                            (mx.ScaledLinearSvc(weight="w", tol=1e-8), linear.SQUARED_HINGE)):
        many = dict(estimator.fitMultiple(rows, [{estimator.C: 1.0}, {estimator.C: 50.0}]))
        packed = linear.blocks(rows, weight="w")
        fits = linear.solve(packed, [linear.Problem(0, 1.0), linear.Problem(0, 50.0)], loss, tolerance=1e-8)
        for i, fit in enumerate(fits):
            mine = dict(many[i].transform(rows).select("w", "prediction").collect())
            assert [mine[v] for v in s] == (x @ fit.weights.T + fit.intercept).argmax(axis=1).tolist()


def test_gradient_of_a_text_model_is_small(spark):
    df = spark.createDataFrame([(i, "own%d word%d here" % (i % 4, i % 7), float(i % 4)) for i in range(200)],
                               "post_id int, text_content string, label double")
    featured = fx.text_stages()[0].fit(df).transform(df)
    packed = linear.blocks(featured)
    fit, = linear.solve(packed, [linear.Problem(0, 1.0)], linear.LOGISTIC)
    assert fit.gradient <= 1e-4 and fit.passes < 100


def test_epsilon_insensitive_line(spark):
    """Absolute errors: a few wild points don't move the line; the cost is near the brute-force optimum."""
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, 60)
    y = 2 * x + 0.5
    y[:6] += 100
    df = spark.createDataFrame([(Vectors.dense([float(a)]), float(b)) for a, b in zip(x, y)], ["features", "label"])
    model = mx.ScaledLinearSvr(C=100.0, epsilon=0.01, tol=1e-7).fit(df)
    w, b = model.coefficients[0], model.intercept
    assert abs(w - 2) < 0.05 and abs(b - 0.5) < 0.05

    def cost(w, b):
        return (w * w + b * b) / 2 + 100 * np.maximum(0, np.abs(w * x + b - y) - 0.01).sum()

    grid = min(cost(a, c) for a in np.linspace(1.95, 2.05, 101) for c in np.linspace(0.45, 0.55, 101))
    assert cost(w, b) <= grid + 100 * 60 * 5e-5


def test_cut_features_equal_a_smaller_vocabulary(spark):
    texts = [(i, " ".join(["aa", "bb", "cc", "dd"][: 1 + i % 4] * (1 + i % 2)), float(i % 2)) for i in range(12)]
    df = spark.createDataFrame(texts, "post_id int, text_content string, label double").coalesce(1)
    wide, small = (linear.blocks(fx.text_stages(max_features=n)[0].fit(df).transform(df)).collect()[0] for n in (50, 3))
    got = search.cut(wide, 0, 3)
    assert (got.starts == small.starts).all() and (got.columns == small.columns).all()
    assert np.allclose(got.values, small.values) and got.width == small.width == 3


def test_batched_search_equals_separate_fits(spark):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words, 6)) + (f" sign{i % 3}" if rng.random() < 0.5 else ""), float(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "post_id int, text_content string, label double")
    vectorizer, last = fx.text_stages(min_df=2)[0], mx.ScaledLogistic()
    grid = [{last.C: c, vectorizer.grams: g, vectorizer.maxFeatures: n} for c, g, n in ((0.5, 1, 15), (20.0, 2, 60))]
    stages = [vectorizer, last]
    assert search.batch(mx.SharedPipeline(stages=stages), grid) and search.batch(Pipeline(stages=stages), grid) is None
    both = [evaluation.cross_validate(kind(stages=stages), df, "post_id", 2, evaluation.MacroF1(), grid)
            for kind in (Pipeline, mx.SharedPipeline)]
    assert np.allclose(both[0].avgMetrics, both[1].avgMetrics, atol=0.02)
    assert both[1].bestModel.transform(df).count() == 150


def test_folds_share_the_passes_of_linear_models(spark, monkeypatch):
    """All folds and the final fit are one run of the solver, with the measures of separate pipelines."""
    rng = np.random.default_rng(6)
    rows = [(i, float(rng.normal() + i % 3), float(rng.normal()), float(i % 3)) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, a double, b double, label double").persist()
    train, test = df.where("id < 180"), df.where("id >= 180")
    stages = fx.context_stages(["a", "b"])
    models = {"logistic": mx.ScaledLogistic(), "svc": mx.ScaledLinearSvc(), "forest": mx.random_forest(trees=5, depth=3)}
    folded = evaluation.fold_column(train, "id", 3, "label").persist()
    pairs = [*evaluation._fold_pairs(folded, 3), (train, test)]
    want = {name: [evaluation.classifier_measure(mx.pipeline(stages, m).fit(a).transform(b)).first() for a, b in pairs]
            for name, m in models.items()}
    calls, solve = [], linear.solve
    monkeypatch.setattr(linear, "solve", lambda rows, problems, *args: calls.append(len(problems)) or solve(rows, problems, *args))
    found = evaluation.compare_classifiers(spark, stages, models, train, test, "id", k=3).collect()
    assert calls == [4, 4]
    for row in found:
        f1 = [r["f1_macro"] for r in want[row["model"]]]
        assert abs(row["cv_f1_mean"] - sum(f1[:3]) / 3) < 0.02 and abs(row["test_f1_macro"] - f1[3]) < 0.02


def test_search_keeps_its_rows_once(spark, monkeypatch):
    """While candidates are fitted, the packed rows are all that is kept: no copy for each setting, no texts."""
    rows = [(i, f"own{i % 3} number n{i % 7} word w{i % 5}", float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "post_id int, text_content string, label double")
    vectorizer, logistic = fx.text_stages()[0], mx.ScaledLogistic()
    grid = [{logistic.C: c, vectorizer.maxFeatures: size} for c in (1.0, 10.0) for size in (5, 30)]
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, during, solve = kept(), [], linear.solve
    monkeypatch.setattr(linear, "solve", lambda *args: during.append(kept()) or solve(*args))
    evaluation.cross_validate(mx.SharedPipeline(stages=[vectorizer, logistic]), df, "post_id", 2, evaluation.MacroF1(), grid)
    assert during == [before + 1] and kept() == before
