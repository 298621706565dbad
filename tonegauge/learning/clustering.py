"""Topic and context clusters: k-means, bisecting k-means, density clusters, PCA, silhouette."""

from collections.abc import Iterator
from itertools import product
from math import isqrt, sqrt
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.operators.metrics import cluster_agreement
from tonegauge.operators.ordering import dense_index
from tonegauge.session import ensure_checkpoints


def best_kmeans(df: DataFrame, k: int, features: str = "features", starts: int = 10, seed: int = SEED) -> KMeansModel:
    """The run with the least inertia out of several seeds, which share the features."""
    rows = df.select(features).persist()
    try:
        def fit(i: int) -> KMeansModel:
            return KMeans(k=k, seed=seed + i, featuresCol=features, predictionCol="cluster").fit(rows)

        # A run is many short jobs; four at a time keep the executors busy.
        with ThreadPool(4) as pool:
            runs = pool.map(inheritable_thread_target(fit), range(starts), 1)
        return min(runs, key=lambda model: model.summary.trainingCost)
    finally:
        rows.unpersist()


def bisecting(df: DataFrame, k: int, features: str = "features"):
    """Hierarchical clusters, split from the top, which scales with the rows."""
    return BisectingKMeans(k=k, seed=SEED, featuresCol=features, predictionCol="cluster").fit(df)


def sweep_k(
    spark: SparkSession, df: DataFrame, key: str, ks: list[int], features: str = "features",
    starts: int = 10,
) -> DataFrame:
    """Silhouette and inertia per k over all rows, best silhouette first."""
    df = df.persist()
    rows = []
    for k in ks:
        model = best_kmeans(df, k, features, starts)
        value = silhouette(model.transform(df), "cluster", features).first()["silhouette"]
        rows.append((k, value, float(model.summary.trainingCost)))
    df.unpersist()
    return spark.createDataFrame(rows, "k int, silhouette double, inertia double").orderBy(
        F.col("silhouette").desc_nulls_last(), "k")


def as_array(df: DataFrame, features: str) -> Column:
    """Features as an array of doubles, from a vector or an array column."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(F.col(features))
    return F.col(features).cast("array<double>")


def silhouette(
    df: DataFrame, cluster: str, features: str = "features", noise: int = -1, digits: int = 4,
) -> DataFrame:
    """Mean silhouette of all rows by squared Euclidean distance, noise left out; one row.

    The mean squared distance of a point to a cluster follows from the cluster's size,
    vector sum and sum of squared norms, so no pair is formed: the work is rows times
    clusters.  Null for fewer than two clusters or where every cluster is one row.
    """
    points = df.where(F.col(cluster) != noise).select(
        F.col(cluster).alias("c"), as_array(df, features).alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    points = points.withColumn("xx", square)
    sizes = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("xx").alias("q"))
    sums = (
        points.select("c", F.posexplode("x").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("v"))
        .groupBy("c").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda e: e["v"]).alias("s"))
    )
    # One row with an entry per cluster.
    table = sizes.join(sums, "c").agg(F.collect_list(F.struct("c", "n", "q", "s")).alias("clusters"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    def distance(entry: Column) -> Column:
        total = entry["n"] * F.col("xx") + entry["q"] - 2 * dot(F.col("x"), entry["s"])
        return F.greatest(total, F.lit(0.0))

    own = F.filter("clusters", lambda e: e["c"] == F.col("c"))[0]
    others = F.filter("clusters", lambda e: e["c"] != F.col("c"))
    scored = points.crossJoin(F.broadcast(table)).select(  # one row
        F.size("clusters").alias("n_clusters"), own["n"].alias("n"),
        F.when(own["n"] > 1, distance(own) / (own["n"] - 1)).alias("inside"),
        F.array_min(F.transform(others, lambda e: distance(e) / e["n"])).alias("nearest"))
    scale = F.greatest("inside", "nearest")
    width = F.when((F.col("n") > 1) & (scale > 0), (F.col("nearest") - F.col("inside")) / scale).otherwise(0.0)
    means = scored.agg(
        F.coalesce(F.max("n_clusters"), F.lit(0)).alias("n_clusters"), F.count(F.lit(1)).alias("n_points"),
        F.round(F.avg(width), digits).alias("silhouette"))
    enough = (F.col("n_clusters") > 1) & (F.col("n_points") > F.col("n_clusters"))
    return means.withColumn("silhouette", F.when(enough, F.col("silhouette")))


def evaluate_clusters(df: DataFrame, cluster: str, label: str, features: str = "features") -> DataFrame:
    """Number of clusters, silhouette, ARI and NMI in one row."""
    outer = cluster_agreement(df, cluster, label).select("ari", "nmi")
    inner = silhouette(df, cluster, features).select("n_clusters", "silhouette")
    return inner.crossJoin(F.broadcast(outer))  # one row


def pca_variance(df: DataFrame, features: str, k: int) -> DataFrame:
    """Explained variance per component and its running sum (k rows)."""
    spark = df.sparkSession
    shares = PCA(k=k, inputCol=features, outputCol="_pca").fit(df).explainedVariance.toArray()
    table = spark.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(shares)], "component int, variance double")
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn("cumulative", F.sum("variance").over(upto))


def pca_project(df: DataFrame, features: str, k: int, out: str = "projected") -> DataFrame:
    """Coordinates on the first k components."""
    return PCA(k=k, inputCol=features, outputCol=out).fit(df).transform(df)


# Density clusters ---------------------------------------------------------------------


def _cells(x: Column, side: float, dims: int) -> list[Column]:
    return [F.floor(x[i] / side).cast("int") for i in range(dims)]


def _distance(a, b) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v))


def _measured(points: DataFrame, pivots: int, eps: float) -> DataFrame:
    """Adds distances ``d`` to the pivots, the widest spread first, and the ``strip`` by the first.

    Pivots are a repeatable choice of ``pivots`` points; any choice gives the same clusters.
    """
    chosen = points.orderBy(F.xxhash64("id"), "id").limit(pivots).agg(
        F.collect_list("x").alias("pivots"))
    measured = points.crossJoin(F.broadcast(chosen)).withColumn(  # one row
        "d", F.transform("pivots", lambda p: _distance(F.col("x"), p))).drop("pivots")
    n = measured.select(F.size("d")).first()
    spread = measured.agg(*[F.stddev_pop(F.col("d")[i]).alias(str(i)) for i in range(n[0] if n else 0)]).first()
    order = sorted(range(len(spread)), key=lambda i: -(spread[i] or 0.0))
    best = F.array(*[F.col("d")[i] for i in order])
    return measured.withColumn("d", best).withColumn("strip", F.floor(F.col("d")[0] / eps))


#: Points of a strip that are compared with others at once; bounds what a worker holds.
BLOCK_POINTS = 2048


def _blocks(points: DataFrame) -> DataFrame:
    """Every strip dealt into blocks of about ``BLOCK_POINTS`` points, a row each."""
    strips = points.groupBy("strip").agg(F.ceil(F.count(F.lit(1)) / BLOCK_POINTS).alias("n"))
    dealt = points.join(strips, "strip").withColumn("block", F.pmod(F.xxhash64("id"), F.col("n")))
    return dealt.groupBy("strip", "block").agg(
        F.collect_list(F.struct("id", "x", "cell", F.col("w").cast("bigint").alias("w"))).alias("points"))


def _meetings(blocks: DataFrame) -> DataFrame:
    """Pairs of blocks that can hold near points: of one strip, and of neighbouring strips."""
    names = blocks.select("strip", "block")
    left = names.select(F.col("strip").alias("astrip"), F.col("block").alias("ablock"),
                        F.explode(F.array("strip", F.col("strip") + 1)).alias("strip"))
    return left.join(names, "strip").where((F.col("strip") > F.col("astrip")) | (F.col("block") >= F.col("ablock")))


def _matched(eps: float):
    def near(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        # Products are rounded; what they leave is measured again as a sum of squared differences.
        most = eps * eps * (1 + 1e-9) + 1e-12 * (aa.max() + bb.max())
        for low in range(0, len(a), 256):
            square = aa[low:low + 256, None] + bb - 2 * (a[low:low + 256] @ b.T)
            i, j = np.nonzero(square <= most)
            i += low
            exact = np.zeros(len(i))
            for x, y in zip(a.T, b.T):
                exact += (x[i] - y[j]) * (x[i] - y[j])
            close = exact <= eps * eps
            yield i[close], j[close]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                l, r = (batch.column(c).slice(at, 1).flatten() for c in ("l", "r"))
                a, b = (v.field("x").flatten().to_numpy().reshape(len(v), -1) for v in (l, r))
                # Pairs inside a strip and block meet once, by position.
                itself = batch.column("itself")[at].as_py()
                cells = [v.field("cell").to_numpy(zero_copy_only=False) for v in (l, r)]
                for i, j in near(a, b):
                    apart = cells[0][i] != cells[1][j]
                    if itself:
                        apart &= i < j
                    i, j = pa.array(i[apart]), pa.array(j[apart])
                    yield pa.RecordBatch.from_pydict({
                        side + name: v.field(field).take(k) for side, v, k in (("a", l, i), ("b", r, j))
                        for name, field in (("", "id"), ("cell", "cell"), ("w", "w"))})

    return run


def near_candidates(points: DataFrame, eps: float) -> DataFrame:
    """Pairs of points in different cells within eps of each other, each pair once.

    Points meet by blocks: a strip's with each other and with the next strip's, two blocks
    in a row, whose distances are one matrix product.
    """
    blocks = _blocks(points).checkpoint()
    one = blocks.select(F.col("strip").alias("astrip"), F.col("block").alias("ablock"), F.col("points").alias("l"))
    other = blocks.withColumnRenamed("points", "r")
    both = _meetings(blocks).join(one, ["astrip", "ablock"]).join(other, ["strip", "block"]).select(
        "l", "r", ((F.col("strip") == F.col("astrip")) & (F.col("block") == F.col("ablock"))).alias("itself"))
    kind = points.schema["id"].dataType.simpleString()
    return both.mapInArrow(
        _matched(eps), f"a {kind}, acell string, aw bigint, b {kind}, bcell string, bw bigint")


def _near(points: DataFrame, eps: float) -> DataFrame:
    """Both directions of every pair of points in different cells within eps of each other."""
    both = F.array(
        F.struct("a", "acell", "b", "bcell", F.col("bw").alias("w")),
        F.struct(F.col("b").alias("a"), F.col("bcell").alias("acell"), F.col("a").alias("b"),
                 F.col("acell").alias("bcell"), F.col("aw").alias("w")))
    return near_candidates(points, eps).select(F.inline(both))


#: Dimensions up to which cells look up the cells around them, whose number is a power of it.
GRID_DIMS = 3


def _square(a: Column, b: Column, dims: int) -> Column:
    """Squared distance of two vectors of few dimensions."""
    return sum(((a[i] - b[i]) * (a[i] - b[i]) for i in range(dims)), F.lit(0.0))


def _gap(a: Column, b: Column, dims: int) -> Column:
    """Squared distance of two boxes (lo, hi); no points in them are closer."""
    apart = [F.greatest(b["lo"][i] - a["hi"][i], a["lo"][i] - b["hi"][i], F.lit(0.0)) for i in range(dims)]
    return sum((v * v for v in apart), F.lit(0.0))


def _around(dims: int, half: bool = False) -> Column:
    """Places of the cells that can hold a point within eps of one in the cell ``at``, itself left out."""
    reach = range(-isqrt(dims) - 1, isqrt(dims) + 2)
    steps = [s for s in product(reach, repeat=dims) if sum(max(abs(v) - 1, 0) ** 2 for v in s) <= dims]
    kept = [s for s in steps if s > (0,) * dims or not half and any(s)]
    return F.array(*[F.array(*[F.col("at")[i] + F.lit(v) for i, v in enumerate(s)]) for s in kept])


def thin_pairs(points: DataFrame, in_cell: DataFrame, min_samples: int, eps: float, dims: int) -> DataFrame:
    """Points near those of cells that ``min_samples`` does not fill, from the cells around.

    A thin cell has fewer than ``min_samples`` points, so a point meets a bounded number of
    them however many points there are.
    """
    thin = points.join(in_cell.where(F.col("cell_w") < min_samples), "cell").select(
        F.col("id").alias("a"), F.col("cell").alias("acell"), F.col("x").alias("ax"), F.explode(_around(dims)).alias("at"))
    other = points.select(F.col("id").alias("b"), F.col("cell").alias("bcell"), F.col("x").alias("bx"), "at", "w")
    return thin.join(other, "at").where(_square(F.col("ax"), F.col("bx"), dims) <= eps * eps).select(
        "a", "acell", "b", "bcell", "w")


def _full_meetings(points: DataFrame, in_cell: DataFrame, min_samples: int, eps: float, dims: int) -> DataFrame:
    """Pairs of full cells whose boxes are within eps, and whether their outermost points prove them linked."""
    known = [F.when(~F.isnan(F.col("x")[i]), F.col("x")[i]) for i in range(dims)]
    ways = [w for w in product((-1.0, 0.0, 1.0), repeat=dims) if any(w)]
    cells = points.join(in_cell.where(F.col("cell_w") >= min_samples), "cell").groupBy("cell", "at").agg(
        F.array(*map(F.min, known)).alias("lo"), F.array(*map(F.max, known)).alias("hi"),
        F.array(*[F.max_by("x", sum((F.col("x")[i] * v for i, v in enumerate(w) if v), F.lit(0.0)))
                  for w in ways]).alias("ends")).checkpoint()
    one = cells.select(F.struct("cell", "lo", "hi").alias("u"), F.col("ends").alias("p"),
                       F.explode(_around(dims, half=True)).alias("at"))
    both = one.join(cells.select(F.struct("cell", "lo", "hi").alias("v"), F.col("ends").alias("q"), "at"), "at")
    linked = F.exists("p", lambda p: F.exists("q", lambda q: _square(p, q, dims) <= eps * eps))
    return both.where(_gap(F.col("u"), F.col("v"), dims) <= eps * eps).select(
        "u", "v", F.coalesce(linked, F.lit(False)).alias("linked"))


def _touching(open_pairs: DataFrame, points: DataFrame, eps: float, dims: int) -> DataFrame:
    """The pairs of cells (u, v) that hold points within eps, from the points of each near the other's box."""
    def facing(own: str, other: str, name: str) -> DataFrame:
        spot = F.struct(F.col("x").alias("lo"), F.col("x").alias("hi"))
        return (
            open_pairs.withColumn("cell", F.col(own)["cell"]).join(points.select("cell", "x"), "cell")
            .where(_gap(spot, F.col(other), dims) <= eps * eps)
            .select(F.col("u")["cell"].alias("ucell"), F.col("v")["cell"].alias("vcell"), F.col("x").alias(name)))

    return facing("u", "v", "p").join(facing("v", "u", "q"), ["ucell", "vcell"]).where(
        _square(F.col("p"), F.col("q"), dims) <= eps * eps).select("ucell", "vcell").distinct()


def _is_star_forest(links: DataFrame) -> bool:
    """Does every node hang on one root, and no root on another node?"""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))))
    roles = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return roles.where("child > 1 OR (child = 1 AND parent = 1)").isEmpty()


def _minimum_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id reachable from each node.

    Alternates large-star and small-star steps, which need a logarithmic number of
    rounds.  Each round is checkpointed to the shared folder, so the plan stays short
    and a lost executor costs one round, not all.
    """
    links = edges.select("u", "v").distinct()
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where(F.col("u") != F.col("v")).distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(lowest, "u")
        small = hung.select("u", F.col("m").alias("v")).union(
            hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = small.distinct().checkpoint()
        links = after
        if _is_star_forest(links):
            break
    roots = links.groupBy("u").agg(F.min("v").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def _cell_links(cells: DataFrame, names: DataFrame) -> DataFrame:
    """Links of the nodes that stand for the cells ``ucell`` and ``vcell``."""
    return cells.join(names.toDF("ucell", "u"), "ucell").join(names.toDF("vcell", "v"), "vcell").select("u", "v")


def dbscan(
    df: DataFrame, key: str, features: str, eps: float, min_samples: int, pivots: int = 16,
) -> DataFrame:
    """Exact density clusters; adds ``cluster`` (-1 is noise).

    A cluster is named by the smallest key of its core points, numbered from 0 in
    that order; a border point joins the first such cluster it touches.

    * Equal vectors collapse to one weighted point, so copies cost nothing.
    * Points in one cell of side eps / sqrt(d) are neighbours by construction.  Such
      cells are the nodes of the graph, and no pair inside a cell is ever formed.
    * Other neighbours are found from distances to ``pivots`` points: two points within eps
      of each other differ by at most eps in their distance to any pivot.  The pivot whose
      distances spread most deals the points into strips of width eps, joined with
      themselves and the next strip, block by block.  Matches are written once.
    * In up to ``GRID_DIMS`` dimensions a cell looks up the cells around it instead.  A cell
      with ``min_samples`` points is core throughout and only needs its links: its outermost points
      prove most of them, and what is left between clusters is settled by points that face
      each other.  Pairs of points are formed only where a cell is not full.
    """
    ensure_checkpoints(df.sparkSession)
    rows = df.select(F.col(key).alias("id"), as_array(df, features).alias("x"))
    size = rows.select(F.size("x")).first()
    if size is None:
        return df.withColumn("cluster", F.lit(-1))
    dims = size[0]
    points = (
        rows.groupBy("x").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("id"))
        .withColumn("at", F.array(*_cells(F.col("x"), eps / sqrt(dims), dims)))
        .withColumn("cell", F.md5(F.concat_ws(",", "at")))
    ).checkpoint()
    in_cell = points.groupBy("cell").agg(F.sum("w").alias("cell_w"))
    grid = dims <= GRID_DIMS
    if grid:
        near = thin_pairs(points, in_cell, min_samples, eps, dims).checkpoint()
    else:
        near = _near(_measured(points.drop("at"), pivots, eps).checkpoint(), eps).checkpoint()
    outside = near.groupBy("a").agg(F.sum("w").alias("more"))
    core = (
        points.join(in_cell, "cell").join(outside, points["id"] == outside["a"], "left")
        .withColumn("core", F.col("cell_w") + F.coalesce("more", F.lit(0)) >= min_samples)
        .select("id", "cell", "core")
    ).checkpoint()
    cores = core.where("core").select("id", "cell")
    names = cores.groupBy("cell").agg(F.min("id").alias("node"))
    first = cores.join(names, "cell")
    links = (
        near.join(first.select(F.col("id").alias("a"), F.col("node").alias("u")), "a")
        .join(first.select(F.col("id").alias("b"), F.col("node").alias("v")), "b")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    )
    if grid:
        met = _full_meetings(points, in_cell, min_samples, eps, dims).checkpoint()
        links = links.union(_cell_links(met.where("linked").select("u.cell", "v.cell").toDF("ucell", "vcell"), names))
        links = links.checkpoint()
        roots = _minimum_labels(names.select("node"), links).checkpoint()
        rooted_cells = names.join(roots, "node").select("cell", "root")
        open_pairs = (
            met.where("NOT linked").join(rooted_cells.toDF("ucell", "uroot"), F.col("u.cell") == F.col("ucell"))
            .join(rooted_cells.toDF("vcell", "vroot"), F.col("v.cell") == F.col("vcell"))
            .where("uroot != vroot").select("u", "v")).checkpoint()
        more = _cell_links(_touching(open_pairs, points, eps, dims), names).checkpoint()
        if not more.isEmpty():
            roots = _minimum_labels(names.select("node"), links.union(more))
    else:
        roots = _minimum_labels(names.select("node"), links)
    rooted = first.join(roots, "node").select("id", "root")
    # A border point may touch core points of other cells and of its own.
    edge = core.where("NOT core")
    beyond = (
        near.join(edge.select(F.col("id").alias("a")), "a")
        .join(rooted.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "root")
    )
    within = edge.join(names.join(roots, "node"), "cell").select("id", "root")
    border = beyond.unionByName(within).groupBy("id").agg(F.min("root").alias("root"))
    assigned = rooted.unionByName(border)
    by_vector = points.select("id", "x").join(assigned, "id").select("x", "root")
    labelled = rows.join(by_vector, "x", "left").select("id", "root")
    numbers = dense_index(roots, "root", "cluster")
    numbered = labelled.join(numbers, "root", "left").select(
        F.col("id").alias(key), F.coalesce(F.col("cluster").cast("int"), F.lit(-1)).alias("cluster"))
    return df.join(numbered, key)


def noise_rate(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters found and share of noise in percent."""
    return df.agg(
        F.count_distinct(F.when(F.col(cluster) >= 0, F.col(cluster))).alias("n_clusters"),
        F.round(F.avg((F.col(cluster) == -1).cast("int")) * 100, 2).alias("noise_pct"))
