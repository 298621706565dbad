"""Agglomerative clusters by Ward's criterion.

Equal vectors are one weighted point.  Points are grouped into at most ``most``
micro-clusters, by k-means where there are more points than that; up to ``most`` distinct
points the hierarchy is exact.  Only sizes and means of micro-clusters reach the driver, so
the tree over them is bounded by ``most`` whatever the number of rows.
"""

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.learning.clustering import as_array
from tonegauge.session import ensure_checkpoints

MOST = 1000


def ward_merges(sizes: np.ndarray, means: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) in order of height; a and b are points of the two clusters.

    Follows nearest neighbours until two clusters are each other's nearest and merges those,
    which for Ward's criterion gives the same tree as always merging the closest two.  The
    height is sqrt(2 n m / (n + m)) times the distance of the means, which for two single
    points is their distance.  Ties go to the cluster before in the chain, then to the lower
    number.
    """
    m = len(sizes)
    n = np.asarray(sizes, float).copy()
    means = np.asarray(means, float)
    apart = np.empty((m, m))
    for i in range(m):
        apart[i] = ((means - means[i]) ** 2).sum(1) * (2 * n * n[i] / (n + n[i]))
    np.fill_diagonal(apart, np.inf)
    alive = np.ones(m, bool)
    merges, chain = [], []
    while len(merges) < m - 1:
        if not chain:
            chain.append(int(np.argmax(alive)))
        here = chain[-1]
        near = int(np.argmin(apart[here]))
        if len(chain) > 1 and apart[here, chain[-2]] <= apart[here, near]:
            near = chain[-2]
        if len(chain) < 2 or near != chain[-2]:
            chain.append(near)
            continue
        del chain[-2:]
        a, b = sorted((here, near))
        height = apart[a, b]
        merges.append((a, b, float(np.sqrt(height))))
        # Lance-Williams: distances to the merged cluster from those to its parts.
        alive[b] = False
        others = alive.copy()
        others[a] = False
        total = n[others] + n[a] + n[b]
        joined = ((n[others] + n[a]) * apart[a, others] + (n[others] + n[b]) * apart[b, others]
                  - n[others] * height) / total
        apart[a, others] = apart[others, a] = np.maximum(joined, 0.0)
        apart[b, :] = apart[:, b] = np.inf
        n[a] += n[b]
    return sorted(merges, key=lambda merge: merge[2])


def cut(merges: list[tuple[int, int, float]], points: int, k: int) -> list[int]:
    """Cluster of each point once k clusters are left, numbered by their first points."""
    root = list(range(points))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b, _ in merges[:max(0, points - k)]:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    numbers: dict[int, int] = {}
    return [numbers.setdefault(find(i), len(numbers)) for i in range(points)]


def _finite(x: Column) -> Column:
    """No missing or infinite component, and at least one."""
    return (F.size(x) > 0) & F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))


def _micro(df: DataFrame, features: str, most: int) -> tuple[DataFrame, list]:
    """Distinct points with their micro-cluster, and (micro, n, mean) of each in order of the mean."""
    ensure_checkpoints(df.sparkSession)
    points = (df.select(as_array(df, features).alias("x")).where(_finite(F.col("x")))
              .groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("n"))
              .select("x", "n", F.xxhash64("x").alias("micro"))).checkpoint()
    if points.limit(most + 1).count() > most:
        points = points.withColumn("v", array_to_vector("x"))
        model = KMeans(k=most, seed=SEED, featuresCol="v", predictionCol="near", weightCol="n").fit(points)
        points = model.transform(points).select("x", "n", "v", F.col("near").cast("long").alias("micro"))
        stats = points.groupBy("micro").agg(
            F.sum("n").alias("n"), vector_to_array(Summarizer.mean(F.col("v"), F.col("n"))).alias("mean"))
    else:
        stats = points.select("micro", "n", F.col("x").alias("mean"))
    return points.select("x", "micro"), stats.orderBy("mean").collect()


def _merges(stats: list) -> list[tuple[int, int, float]]:
    if not stats:
        return []
    return ward_merges(np.array([r["n"] for r in stats]), np.array([r["mean"] for r in stats], float))


def ward(df: DataFrame, k: int, features: str = "features", most: int = MOST, cluster: str = "cluster") -> DataFrame:
    """Adds the cluster (0 to k - 1, in order of the smallest vectors) of each row.

    Repeated rows share a cluster.  With fewer distinct vectors than ``k`` each is a cluster.
    Rows whose vector is missing, empty or not finite have a null cluster and don't count.
    """
    if not 1 <= k <= most:
        raise ValueError(f"k is {k}, not within 1 and the number of micro-clusters, {most}")
    points, stats = _micro(df, features, most)
    labels = cut(_merges(stats), len(stats), k)
    named = df.sparkSession.createDataFrame(
        [(r["micro"], label) for r, label in zip(stats, labels)], "micro long, _cluster int")
    found = points.join(F.broadcast(named), "micro").select(F.col("x").alias("_x"), "_cluster")  # most rows
    return (df.withColumn("_x", as_array(df, features)).join(found, "_x", "left")
            .withColumn(cluster, F.col("_cluster")).drop("_x", "_cluster"))


def ward_tree(df: DataFrame, features: str = "features", most: int = MOST) -> DataFrame:
    """The merges, lowest first: step, left, right, height, n_rows.

    Micro-clusters are 0 to m - 1 in order of their means; step i makes the cluster m + i.
    """
    _, stats = _micro(df, features, most)
    m = len(stats)
    name, sizes = list(range(m)), [int(r["n"]) for r in stats]
    group = [[i] for i in range(m)]
    at, rows = list(range(m)), []
    for step, (a, b, height) in enumerate(_merges(stats)):
        a, b = at[a], at[b]
        low, high = sorted((name[a], name[b]))
        if len(group[a]) < len(group[b]):
            a, b = b, a
        for point in group[b]:
            at[point] = a
        group[a] += group[b]
        name[a], sizes[a] = m + step, sizes[a] + sizes[b]
        rows.append((step, low, high, height, sizes[a]))
    return df.sparkSession.createDataFrame(rows, "step int, left int, right int, height double, n_rows long")
