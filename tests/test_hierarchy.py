"""Ward's hierarchy against always merging the closest two clusters."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonegauge.learning import hierarchy


def brute(sizes, means):
    """(members, height) of each merge, by trying all pairs at each step."""
    clusters = {frozenset([i]): (float(n), np.asarray(x, float)) for i, (n, x) in enumerate(zip(sizes, means))}
    steps = []
    while len(clusters) > 1:
        def cost(pair):
            (n, x), (m, y) = clusters[pair[0]], clusters[pair[1]]
            return 2 * n * m / (n + m) * ((x - y) ** 2).sum()
        a, b = min(itertools.combinations(clusters, 2), key=cost)
        height = np.sqrt(cost((a, b)))
        (n, x), (m, y) = clusters.pop(a), clusters.pop(b)
        clusters[a | b] = n + m, (n * x + m * y) / (n + m)
        steps.append((a | b, height))
    return steps


def grouped(labels):
    found = {}
    for i, label in enumerate(labels):
        found.setdefault(label, set()).add(i)
    return {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("seed", range(6))
def test_chains_give_the_tree_of_closest_pairs(seed):
    rng = np.random.default_rng(seed)
    m = 40
    sizes, means = rng.integers(1, 9, m), rng.normal(size=(m, 3))
    merges, steps = hierarchy.ward_merges(sizes, means), brute(sizes, means)
    assert np.allclose([h for *_, h in merges], [h for _, h in steps])
    for k in (1, 2, 5, 17, 40, 50):
        clusters = {frozenset([i]) for i in range(m)}
        for members, _ in steps[:max(0, m - k)]:
            clusters = {c for c in clusters if not c <= members} | {members}
        assert grouped(hierarchy.cut(merges, m, k)) == clusters


def test_ties_end_and_leave_k_clusters():
    means = np.array([[x, y] for x in range(6) for y in range(6)], float)
    merges = hierarchy.ward_merges(np.ones(36), means)
    assert len(merges) == 35
    assert all(len(grouped(hierarchy.cut(merges, 36, k))) == k for k in range(1, 37))


def test_rows_share_the_tree_of_their_distinct_vectors(spark):
    rng = np.random.default_rng(7)
    points = [list(map(float, p)) for p in rng.normal(size=(25, 2))]
    rows = [(100 * i + j, p) for i, p in enumerate(points) for j in range(1 + i % 4)]
    df = spark.createDataFrame(rows, "id int, features array<double>").withColumn("cluster", F.lit("old"))
    got = {r["id"]: r["cluster"] for r in hierarchy.ward(df, 4).collect()}
    assert len(got) == len(rows)
    order = sorted(range(25), key=lambda i: points[i])
    steps = brute([1 + i % 4 for i in order], [points[i] for i in order])
    clusters = {frozenset([i]) for i in range(25)}
    for members, _ in steps[:21]:
        clusters = {c for c in clusters if not c <= members} | {members}
    assert grouped([got[100 * i] for i in order]) == clusters
    assert all(got[100 * i + j] == got[100 * i] for i in range(25) for j in range(1 + i % 4))
    tree = hierarchy.ward_tree(df).orderBy("step").collect()
    assert np.allclose([r["height"] for r in tree], [h for _, h in steps])
    assert tree[-1]["n_rows"] == len(rows)
    assert sorted(i for r in tree for i in (r["left"], r["right"])) == list(range(2 * 25 - 2))


def test_micro_clusters_bound_the_tree(spark):
    df = spark.range(2000).select(
        "id", F.array((F.col("id") % 4 * 100 + F.col("id") % 61 / 61).cast("double"),
                      (F.col("id") % 59 / 59).cast("double")).alias("features"))
    tree = hierarchy.ward_tree(df, most=50).collect()
    assert len(tree) <= 49 and max(r["n_rows"] for r in tree) == 2000
    found = hierarchy.ward(df, 4, most=50)
    assert found.groupBy((F.col("id") % 4).alias("g")).agg(
        F.count_distinct("cluster").alias("n")).where("n = 1").count() == 4
    assert found.select("cluster").distinct().count() == 4


def test_rows_without_a_vector_have_no_cluster(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0]), (2, [-0.0]), (3, [9.0]), (4, None), (5, [None]), (6, [nan]), (7, [inf]), (8, [])]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    got = {r["id"]: r["cluster"] for r in hierarchy.ward(df, 2).collect()}
    assert got == {1: 0, 2: 0, 3: 1} | dict.fromkeys(range(4, 9))
    assert {r["cluster"] for r in hierarchy.ward(df, 5).where("id < 4").collect()} == {0, 1}
    none = df.where("id > 3")
    assert hierarchy.ward(none, 2).where("cluster is null").count() == 5
    assert hierarchy.ward_tree(none).count() == 0
    assert hierarchy.ward(df.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        hierarchy.ward(df, 0)
