"""Models and clusters against closed forms and brute force on small inputs."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tonegauge.learning import clustering, evaluation, tasks
from tonegauge.learning import features as fx
from tonegauge.learning import models as mx
from tonegauge.operators import terms

TEXTS = [
    ("I love this great phone", "Positive"), ("great service, love it", "Positive"),
    ("love love love", "Positive"), ("a great day", "Positive"),
    ("the phone is a phone", "Neutral"), ("it arrived on monday", "Neutral"),
    ("monday service as usual", "Neutral"), ("usual day on the phone", "Neutral"),
    ("terrible awful phone", "Negative"), ("awful service, I hate it", "Negative"),
    ("hate this terrible day", "Negative"), ("awful awful monday", "Negative"),
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "post_id int, text_content string, sentiment_label string")


def matrix(df, column="features"):
    return np.array([r[0] for r in df.orderBy("post_id").select(vector_to_array(column)).collect()])


def test_workers_add_up_terms_of_many_texts(monkeypatch):
    """Each distinct term of a slice leaves a worker once, with occurrences and documents, and no slice is large."""
    import pyarrow as pa
    from collections import Counter
    from tonegauge.operators import terms
    monkeypatch.setattr(terms, "COUNT_TOKENS", 5)
    words = [["aa", "bb", "aa", "bb"], [], ["aa"], ["bb", "aa"], ["cc"] * 7, [], ["aa", "cc"]]
    groups = [0, 1, 1, 0, 2, 2, 1]
    batch = pa.RecordBatch.from_pydict({"_group": pa.array(groups, pa.int32()), "_words": pa.array(words, pa.list_(pa.string()))})
    total, held, sent = Counter(), Counter(), 0
    for part in terms._counted(True)(iter([batch.slice(0, 3), batch.slice(3)])):
        sent += part.num_rows
        for r in part.to_pylist():
            total[r["_group"], r["term"]] += r["total"]
            held[r["_group"], r["term"]] += r["df"]
    every = [(g, w + [f"{a} {b}" for a, b in zip(w, w[1:])]) for g, w in zip(groups, words)]
    assert total == Counter((g, t) for g, w in every for t in w)
    assert held == Counter((g, t) for g, w in every for t in set(w))
    assert sent < sum(len(w) for _, w in every)


def test_pairs_that_cannot_be_in_the_vocabulary_stay_behind(spark):
    """A limited vocabulary equals brute force, and rare pairs are never named."""
    import re
    from collections import Counter
    rng = random.Random(3)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
    rows = [" ".join(rng.choice(words[:rng.choice((5, 20, 60))]) for _ in range(rng.randrange(0, 30))) for _ in range(200)]
    rows += [None, "", "aa", "aa aa aa"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(3)
    total, held = Counter(), Counter()
    for t in rows:
        w = re.findall(r"\w{2,}", t or "")
        total.update(own := w + [f"{a} {b}" for a, b in zip(w, w[1:])])
        held.update(set(own))
    for most, least in ((1, 1), (40, 2), (60, 1), (70, 1), (5000, 4), (61, 50), (5000, 5000)):
        want = sorted(((t, n, held[t]) for t, n in total.items() if held[t] >= least), key=lambda r: (-r[1], r[0].encode()))
        assert [tuple(r) for r in terms.corpus_vocabulary(df, "t", 2, most, least).collect()] == want[:most]
    named = terms._frequent_terms(terms._words(df, [], "t", None), 10, 1)
    assert named.count() < len(total) / 4


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(0, "aa bb aa"), (1, "bb cc")], "post_id int, text_content string")
    model = Pipeline(stages=fx.text_stages(grams=1)).fit(df)
    vocabulary = model.stages[0].stages[1].vocabulary
    got = matrix(model.transform(df))[0]
    rare = np.log(3 / 2) + 1
    want = {"aa": 2 * rare, "bb": 1.0, "cc": 0.0}
    norm = np.hypot(want["aa"], want["bb"])
    assert [round(v, 9) for v in got] == [round(want[t] / norm, 9) for t in vocabulary]


def test_svd_equals_numpy(spark, texts):
    stages = fx.reduced_text_stages(max_features=50, components=3)
    model = Pipeline(stages=stages).fit(texts)
    out = model.transform(texts)
    _, sizes, vt = np.linalg.svd(matrix(out, "tfidf"), full_matrices=False)
    got = matrix(out)
    assert np.allclose(np.linalg.norm(got, axis=0), sizes[:3], atol=1e-8)
    assert np.allclose(np.abs(got), np.abs(matrix(out, "tfidf") @ vt[:3].T), atol=1e-8)


def test_pipeline_saves_and_loads(spark, texts, tmp_path):
    df, labels = tasks.coded(texts, "sentiment_label")
    path = str(tmp_path / "model")
    stages = fx.reduced_text_stages(max_features=50, components=3)
    fitted = evaluation.load_or_train(path, lambda: mx.pipeline(stages, mx.ScaledLogistic(maxIter=50)).fit(df))
    loaded = PipelineModel.load(path)
    a, b = (evaluation.score(m, df, labels).orderBy("post_id").collect() for m in (fitted, loaded))
    assert a == b
    assert all(abs(sum(r["probabilities"].values()) - 1) < 1e-3 for r in a)


def test_empty_text_is_rejected_before_scoring(spark, texts):
    df, labels = tasks.coded(texts, "sentiment_label")
    model = mx.pipeline(fx.text_stages(max_features=50), mx.naive_bayes()).fit(df)
    more = df.select("post_id", "text_content").union(
        spark.createDataFrame([(100, ""), (101, None)], "post_id int, text_content string"))
    assert evaluation.score(model, more, labels).count() == len(TEXTS)


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=60)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    centred, target = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(centred.T @ centred + 2.0 * np.eye(3), centred.T @ target)
    got = mx.ScaledRidge(alpha=2.0).fit(df).coefficients.toArray()
    assert np.allclose(got, want, atol=1e-8)


def test_logistic_solves_its_objective(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 2))
    y = (x[:, 0] + 0.5 * rng.normal(size=80) > 0).astype(float)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    model = mx.ScaledLogistic(C=2.0).fit(df)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = 2.0 * x.T @ (p - y) + w
    assert np.abs(gradient).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_scaling_ignores_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0)], "a double, b double")
    out = fx.FillAndScale(inputCols=["a", "b"], fill="median").fit(df).transform(df)
    assert [r["b_scaled"] for r in out.collect()] == [0.0, 0.0, 0.0]
    assert [round(r["a_scaled"], 6) for r in out.collect()] == [-1.224745, 0.0, 1.224745]


def test_most_frequent_tie_and_unknown_category(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    out = fx.FillMostFrequent(inputCols=["c"]).fit(df).transform(df)
    assert [r["c_filled"] for r in out.collect()] == ["b", "a", "a"]


def test_random_grid_is_repeatable():
    draws = {"c": lambda g: mx.log_uniform(g, 1e-2, 1e2), "n": [1, 2, 3]}
    grid = evaluation.random_grid(draws, 20)
    assert grid == evaluation.random_grid(draws, 20)
    assert all(1e-2 <= s["c"] <= 1e2 for s in grid)


def brute_dbscan(points, eps, need):
    """Textbook density clusters; names by smallest core, border to the smallest one."""
    n = len(points)
    near = [[j for j in range(n) if np.linalg.norm(points[i] - points[j]) <= eps] for i in range(n)]
    core = [len(near[i]) >= need for i in range(n)]
    root = [None] * n
    for i in range(n):
        if core[i] and root[i] is None:
            root[i], todo = i, [i]
            while todo:
                for j in near[todo.pop()]:
                    if core[j] and root[j] is None:
                        root[j] = i
                        todo.append(j)
    for i in range(n):
        if not core[i]:
            touched = [root[j] for j in near[i] if core[j]]
            root[i] = min(touched) if touched else None
    names = {r: k for k, r in enumerate(sorted({r for r in root if r is not None}))}
    return [names.get(r, -1) for r in root]


@pytest.mark.parametrize("seed,dims,eps,need", [(1, 2, 0.3, 4), (2, 3, 0.5, 5), (3, 2, 0.15, 3)])
def test_density_clusters_equal_brute_force(spark, seed, dims, eps, need):
    generator = random.Random(seed)
    centres = [[generator.uniform(-2, 2) for _ in range(dims)] for _ in range(4)]
    points = [[c + generator.gauss(0, 0.25) for c in generator.choice(centres)] for _ in range(150)]
    points += [points[0]] * 40  # copies of one point
    points += [[generator.uniform(-3, 3) for _ in range(dims)] for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(points)), "id int, x array<double>")
    got = clustering.dbscan(df, "id", "x", eps, need).orderBy("id").collect()
    assert [r["cluster"] for r in got] == brute_dbscan(np.array(points), eps, need)


@pytest.mark.parametrize("seed,dims,need", [(1, 1, 4), (2, 2, 3), (3, 2, 8), (4, 3, 3)])
def test_density_clusters_with_full_cells_equal_brute_force(spark, seed, dims, need):
    rng = np.random.default_rng(seed)
    points = np.vstack([rng.uniform(0, 1, (350, dims)), rng.uniform(1.3, 2, (50, dims)), rng.uniform(0, 4, (30, dims))])
    df = spark.createDataFrame(list(enumerate(points.tolist())), "id int, x array<double>")
    got = clustering.dbscan(df, "id", "x", 0.2, need).orderBy("id").collect()
    assert [r["cluster"] for r in got] == brute_dbscan(points, 0.2, need)


def test_full_cells_link_by_points_that_are_not_outermost(spark):
    """A cell's point in a notch, nearest to the next cell, lies inside the box of the outermost ones."""
    left = [[0.01, 0.01], [0.01, 0.69], [0.66, 0.35], [0.69, 0.01], [0.69, 0.69]]
    right = [[1.4 + 0.65, 0.01], [1.4 + 0.65, 0.69], [1.4 + 0.26, 0.35], [1.4 + 0.255, 0.02], [1.4 + 0.255, 0.68]]
    points = np.array(left + right)
    df = spark.createDataFrame(list(enumerate(points.tolist())), "id int, x array<double>")
    got = clustering.dbscan(df, "id", "x", 1.0, 5).orderBy("id").collect()
    assert [r["cluster"] for r in got] == brute_dbscan(points, 1.0, 5)
    # The outermost points alone must not decide: pairs that they leave open are compared in full.
    points = df.select(F.col("id"), "x", F.when(F.col("id") < 5, "l").otherwise("r").alias("cell"))
    box = lambda name, i: F.struct(
        F.lit(name).alias("cell"), F.array(*[F.lit(float(v)) for v in i.min(axis=0)]).alias("lo"),
        F.array(*[F.lit(float(v)) for v in i.max(axis=0)]).alias("hi"))
    pair = spark.range(1).select(box("l", np.array(left)).alias("u"), box("r", np.array(right)).alias("v"))
    gap = min(np.linalg.norm(np.subtract(p, q)) for p in left for q in right)
    assert clustering._touching(pair, points, gap + 1e-9, 2).count() == 1
    assert clustering._touching(pair, points, gap - 1e-9, 2).count() == 0


def test_pairs_of_points_do_not_grow_with_the_square(spark):
    """Full cells form no pairs: four times the points in a square give at most four times the pairs, not sixteen."""
    def pairs(n):
        x = np.random.default_rng(5).uniform(0, 1, (n, 2))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>")
        points = df.withColumn("at", F.array(*clustering._cells(F.col("x"), 0.2 / 2 ** 0.5, 2))).withColumn(
            "cell", F.md5(F.concat_ws(",", "at"))).withColumn("w", F.lit(1))
        in_cell = points.groupBy("cell").agg(F.sum("w").alias("cell_w"))
        return clustering.thin_pairs(points, in_cell, 5, 0.2, 2).count()

    assert pairs(1600) <= 4 * pairs(400)


def test_density_candidates_are_few(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64)) * np.linspace(4, 0.1, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>")
    points = df.select("id", "x", F.lit(1).alias("w"), F.col("id").cast("string").alias("cell"))
    pairs = clustering.near_candidates(clustering._measured(points, 16, 1.5), 1.5).count()
    assert pairs < 0.1 * 400 * 399 / 2


@pytest.mark.parametrize("block", [7, 2048])
def test_blocks_of_points_find_every_near_pair_once(spark, monkeypatch, block):
    """Blocks of one strip meet each other and the next strip's; distances are exact at the limit."""
    monkeypatch.setattr(clustering, "BLOCK_POINTS", block)
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(120, 3)), [[0.1 * i, 40.0, 0.0] for i in range(30)]])
    df = spark.createDataFrame([(f"p{i}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>")
    points = df.select("id", "x", F.lit(2).alias("w"), (F.xxhash64("id") % 50).cast("string").alias("cell"))
    points = clustering._measured(points, 4, 0.3).checkpoint()
    cell = dict(points.select("id", "cell").collect())
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in clustering.near_candidates(points, 0.3).collect())

    def near(i, j):
        square = 0.0
        for p, q in zip(x[i].tolist(), x[j].tolist()):
            square += (p - q) * (p - q)
        return square <= 0.3 * 0.3

    assert got == sorted(tuple(sorted((f"p{i}", f"p{j}"))) for i in range(150) for j in range(i)
                         if cell[f"p{i}"] != cell[f"p{j}"] and near(i, j))


def test_silhouette_of_noise_and_single_cluster(spark):
    df = spark.createDataFrame(
        [(1, 0, [0.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 1, [5.0, 0.0]), (4, -1, [9.0, 9.0])],
        "id int, c int, features array<double>")
    row = clustering.silhouette(df, "c").first()
    a = [(25 - 1) / 25, (26 - 1) / 26, 0.0]
    assert row["n_clusters"] == 2 and row["silhouette"] == round(sum(a) / 3, 4)
    assert clustering.silhouette(df.where("c <= 0"), "c").first()["silhouette"] is None


def test_best_of_seeds_is_not_worse(spark):
    rows = [(i, Vectors.dense([float(i % 7), float(i % 5)])) for i in range(70)]
    df = spark.createDataFrame(rows, ["id", "features"])
    one = clustering.best_kmeans(df, 4, starts=1).summary.trainingCost
    assert clustering.best_kmeans(df, 4, starts=4).summary.trainingCost <= one + 1e-9


def test_seeds_share_the_features(spark, monkeypatch):
    """What makes the features, a text pipeline say, must not run again for every seed."""
    df = spark.createDataFrame([(i, Vectors.dense([float(i % 7)])) for i in range(70)], ["id", "features"])
    kept, fit = [], clustering.KMeans.fit
    monkeypatch.setattr(clustering.KMeans, "fit", lambda self, rows: kept.append(rows.is_cached) or fit(self, rows))
    clustering.best_kmeans(df, 3, starts=3)
    assert kept == [True] * 3


def test_weights_of_terms_need_no_shuffle(spark):
    """Terms are weighed in their row, with the weights that an unlimited vocabulary's joins give."""
    texts = ["alpha beta alpha gamma", "beta gamma", "", None, "delta", "gamma alpha beta alpha beta", "Éa éa beta"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(2)
    for grams in (1, 2):
        got = terms.tfidf(df, "id", "t", grams, 1000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "hashpartitioning(id" not in plan
        rounded = [{(r["id"], r["term"], r["tf"], round(r["weight"], 9)) for r in d.collect()}
                   for d in (got, terms.tfidf(df, "id", "t", grams, None))]
        assert rounded[0] == rounded[1] and rounded[0]
    few = terms.tfidf(df, "id", "t", 2, 2).collect()
    assert {r["term"] for r in few} == {"alpha", "beta"}


def test_scenarios_of_the_ablation_share_their_features(spark, texts, monkeypatch):
    """The measures of separate pipelines, with the words counted once."""
    from tonegauge.operators import posts
    manual = ["len_chars", "n_words", "n_exclaim"]
    df, _ = tasks.coded(posts.add_manual_text_features(texts), "sentiment_label")
    held = df.where("post_id % 3 = 0")
    want = {}
    for name, stages in (("text", fx.text_stages()), ("manual", fx.context_stages(manual)),
                         ("text_and_manual", fx.text_with_manual_stages("text_content", manual))):
        model = mx.pipeline(stages, mx.ScaledLogistic()).fit(df)
        want[name] = evaluation.MacroF1().evaluate(model.transform(held))
    counted = []
    monkeypatch.setattr(fx, "corpus_vocabulary", lambda *a: counted.append(1) or terms.corpus_vocabulary(*a))
    assert tasks.manual_ablation(df, held, "text_content", manual) == pytest.approx(want)
    assert len(counted) == 1 and len(set(want.values())) > 1


def test_macro_f1_differs_from_weighted(spark):
    df = spark.createDataFrame([(0.0, 0.0)] * 9 + [(1.0, 0.0)], "label double, prediction double")
    assert evaluation.MacroF1().evaluate(df) == pytest.approx((18 / 19) / 2)


def test_shared_pipeline_equals_separate_ones(spark, texts):
    df, _ = tasks.coded(texts, "sentiment_label")
    vectorizer, logistic = fx.text_stages()[0], mx.ScaledLogistic()
    grid = [{logistic.C: c, vectorizer.grams: grams} for c in (0.1, 10.0) for grams in (1, 2)]
    found = [evaluation.cross_validate(kind(stages=[vectorizer, logistic]), df, "post_id", 2, evaluation.MacroF1(), grid)
             for kind in (Pipeline, mx.SharedPipeline)]
    assert np.allclose(found[0].avgMetrics, found[1].avgMetrics)


def test_registered_comparisons_run_the_whole_job(spark, monkeypatch):
    from tonegauge.plans import queries_learning as q

    sf, seen = "/root/testdata/sf0.001", []
    for name in ("compare_classifiers", "compare_regressors", "fold_measures", "cross_validate", "tuning_impact"):
        def caught(*args, name=name, **kwargs):
            seen.append((name, args, kwargs))
            raise StopIteration
        monkeypatch.setattr(evaluation, name, caught)

    def call(query):
        with pytest.raises(StopIteration):
            query(spark, sf)
        return seen[-1][1:]

    args, kwargs = call(q.m12)
    assert kwargs["k"] == 5 and args[2]["random_forest"].getNumTrees() == 100 and args[2]["logistic"].getMaxIter() == 100
    assert args[1][0].getOrDefault(args[1][0].maxFeatures) == 5000
    args, kwargs = call(q.m13)
    assert kwargs["k"] == 3 and {m.getMaxIter() for n, m in args[2].items() if n != "naive_bayes"} == {100}
    for query, k in ((q.m17, 3), (q.m18, 5)):
        args, _ = call(query)
        assert args[4] == k and args[1]["random_forest"].getNumTrees() == 120 and args[1]["gradient_boosting"].getMaxIter() == 100
    args, kwargs = call(q.m19)
    assert kwargs["k"] == 3 and args[2]["random_forest"].getNumTrees() == 40
    args, _ = call(q.m23)
    assert args[3] == 5 and len(args[5]) == 12 and args[0].getStages()[1].getMaxIter() == 1000
    args, _ = call(q.m24)
    assert args[-1] == 5 and [len(g) for g in args[2].values()] == [1, 12, 15]
