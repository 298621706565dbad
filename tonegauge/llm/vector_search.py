"""Exact top-k by inner product over a pivot-distance index.

Vectors get one more component, the root of M^2 - |x|^2 with M the largest length, and queries a zero
there. Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the highest inner products are the nearest neighbours
and the triangle inequality holds: a vector at distance d from a pivot can't be nearer to a query at
distance e from it than |d - e|. The index keys each distinct vector by its nearest pivot and its
distance from it, and cuts the vectors of a pivot, sorted by distance, into shards of bounded size.
A query first searches the annuli around itself at its own pivot; the score it has then bounds the
distance of what may still matter, and only shards (and annuli within them) inside the bound follow.

Defined cases: rows without an id, without a vector, or with a null or non-finite component take no
part, nor do vectors of another length than the most frequent one (ties: the longer). A query's own row
is left out, and only that: a repeated row is a candidate of its copy. Equal vectors are one entry of
the index with their k + 1 smallest ids, which no result can exceed. Empty tables give no rows. Scores
are exact below 2^53. Columns other than the id and the vector are ignored.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonegauge.llm.common import written

#: Pivots are chosen among this many distinct vectors, the first by a hash of the vector.
SAMPLE = 2048
PIVOTS = 64
#: Distances from a pivot are counted in this many steps; the counts say where shards begin.
RINGS = 256
#: Vectors a task holds at once, and those of one annulus.
SHARD = 65_536
ANNULUS = 1024
#: Queries one task looks up in a shard, and those multiplied together.
SLICE = 65_536
TOGETHER = 512


class Shard(NamedTuple):
    pivot: int
    low: float
    high: float


class Directory(NamedTuple):
    """Bounded by pivots and rings, and by rows / SHARD where rings hold more."""

    pivots: np.ndarray
    longest: float
    first: dict[tuple[int, int], tuple[int, int]]
    shards: list[Shard]


def vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, v, a, b): valid vectors with components floor(scale * x), and two hashes that name the vector."""
    whole = df.select(F.col(key).cast("long").alias("vec_id"),
                      F.col(vector).cast("array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    valid = whole.where(~bad)
    usual = valid.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    # floor() of a double is a long; adding 0.0 makes -0.0 and 0.0 the same.
    v = F.transform("x", lambda c: F.floor(c * scale).cast("double") + F.lit(0.0))
    return valid.where(F.size("x") == (usual["n"] if usual else 0)).select("vec_id", v.alias("v")).select(
        "vec_id", "v", F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(a, b, v, ids): equal vectors once, with the k + 1 smallest ids of their rows."""
    order = Window.partitionBy("a", "b").orderBy("vec_id")
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    return few.groupBy("a", "b").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def choose_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Each next pivot is the point farthest from those before it."""
    chosen = points[:1]
    far = np.linalg.norm(points - chosen[0], axis=1)
    while len(chosen) < n and far.max(initial=0) > 0:
        chosen = np.vstack([chosen, points[far.argmax()]])
        far = np.minimum(far, np.linalg.norm(points - chosen[-1], axis=1))
    return chosen


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that gives all of them the same length."""
    rest = np.sqrt(np.maximum(longest ** 2 - (v * v).sum(1), 0))
    return np.column_stack([v, rest])


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def keyed(entries: DataFrame, pivots: np.ndarray, longest: float) -> DataFrame:
    """Adds each vector's nearest pivot, its distance from it and the ring of that distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = distances(lifted(matrix(batch.column("v")), longest), pivots)
            pivot = far.argmin(1)
            near = far[np.arange(len(far)), pivot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot, pa.int32()), pa.array(near, pa.float64()),
                 pa.array(ring(near, longest), pa.int32())], [*batch.schema.names, "pivot", "distance", "ring"])

    return entries.mapInArrow(run, "a long, b long, v array<double>, ids array<long>, pivot int, distance double, ring int")


def ring(distance: np.ndarray, longest: float) -> np.ndarray:
    """All lie within twice the largest length of each other."""
    return np.minimum(distance / (2 * longest or 1.0) * RINGS, RINGS - 1).astype(np.int32)


def directory(index: DataFrame, pivots: np.ndarray, longest: float, size: int) -> Directory:
    """Cuts the rings of each pivot into shards of at most ``size`` vectors; one ring may make several."""
    counts = index.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high"))
    first, shards, held = {}, [], 0
    for row in sorted(counts.collect()):
        pivot, step, n, low, high = row
        if shards and shards[-1].pivot == pivot and held + n <= size:
            shards[-1] = shards[-1]._replace(high=max(shards[-1].high, high))
            first[pivot, step] = len(shards) - 1, 1
            held += n
        else:
            parts = -(-n // size)
            first[pivot, step] = len(shards), parts
            shards += [Shard(pivot, low, high)] * parts
            held = n if parts == 1 else size
    return Directory(pivots, longest, first, shards)


def placed(index: DataFrame, plan: Directory, slices: int) -> DataFrame:
    """The index with the shard of each vector, once for each slice of the queries."""
    spark = index.sparkSession
    rows = [(*key, *value) for key, value in plan.first.items()]
    where = spark.createDataFrame(rows, "pivot int, ring int, shard int, parts int")
    # At most PIVOTS * RINGS rows.
    found = index.join(F.broadcast(where), ["pivot", "ring"])
    return found.select(
        (F.col("shard") + F.pmod("a", "parts")).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"),
        "distance", "a", "b", "v", "ids", F.lit(float("-inf")).alias("bound"))


def reachable(far: np.ndarray, length: np.ndarray, bound: np.ndarray, plan: Directory) -> np.ndarray:
    """Which shards (columns) may hold a vector whose score isn't below the query's bound."""
    pivot = np.array([s.pivot for s in plan.shards], int)
    low, high = np.array([s.low for s in plan.shards]), np.array([s.high for s in plan.shards])
    e = far[:, pivot]
    return np.maximum(np.maximum(e - high, low - e), 0) <= radius(length, bound, plan.longest)[:, None]


def radius(length: np.ndarray, bound: np.ndarray, longest: float) -> np.ndarray:
    """Distance beyond which scores are below the bound, with room for rounding."""
    with np.errstate(invalid="ignore"):
        square = length ** 2 + longest ** 2 - 2 * bound
    return np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-6 * (longest + 1)


def asked(queries: DataFrame, plan: Directory, slices: int, home: bool) -> DataFrame:
    """A row per query and shard to search: the one around the query, or all others within its bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                v, bound = matrix(batch.column("v")), batch.column("bound").to_numpy()
                length = np.sqrt((v * v).sum(1))
                far = distances(np.column_stack([v, np.zeros(len(v))]), plan.pivots)
                here = nearest_shards(far, plan)
                if home:
                    who, shard = np.arange(len(v)), here
                else:
                    reach = reachable(far, length, bound, plan)
                    reach[np.arange(len(v)), here] = False
                    who, shard = np.nonzero(reach)
                for cut in range(0, len(who), 8192):
                    some = pa.array(who[cut:cut + 8192])
                    rows = batch.select(["a", "b", "v", "bound"]).take(some)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard[cut:cut + 8192], pa.int32()), rows.column("a"), rows.column("b"),
                        rows.column("v"), rows.column("bound")], ["shard", "a", "b", "v", "bound"])

    found = queries.mapInArrow(run, "shard int, a long, b long, v array<double>, bound double")
    return found.select(
        "shard", F.pmod("b", F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("kind"),
        F.lit(0.0).alias("distance"), "a", "b", "v", F.lit(None).cast("array<long>").alias("ids"), "bound")


def nearest_shards(far: np.ndarray, plan: Directory) -> np.ndarray:
    """Of the shards of a query's nearest pivot, the one whose distances are closest to the query's."""
    e = far[:, np.array([s.pivot for s in plan.shards], int)]
    low, high = np.array([s.low for s in plan.shards]), np.array([s.high for s in plan.shards])
    gap = np.maximum(np.maximum(e - high, low - e), 0)
    return np.where(e == e.min(1, keepdims=True), gap, np.inf).argmin(1)


class Searcher:
    """One shard: vectors sorted by distance from the pivot, in annuli."""

    def __init__(self, plan: Directory, shard: int, parts: list[pa.RecordBatch], k: int):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        self.ids, self.v, self.k, self.longest = rows.column("ids"), matrix(rows.column("v")), k, plan.longest
        self.pivot = plan.pivots[plan.shards[shard].pivot:][:1]
        self.distance = rows.column("distance").to_numpy()
        offsets = self.ids.offsets.to_numpy()[:-1]
        self.least = self.ids.values.to_numpy(zero_copy_only=False)[offsets]
        self.length = (self.v * self.v).sum(1)

    def search(self, v: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k + 1 best vectors of each query; nearest annuli first."""
        e = distances(np.column_stack([v, np.zeros(len(v))]), self.pivot)[:, 0]
        length = np.sqrt((v * v).sum(1))
        best = (np.empty(0, int), np.empty(0, int), np.empty(0))
        bound, starts = bound.copy(), np.arange(0, len(self.v), ANNULUS)
        ends = np.minimum(starts + ANNULUS, len(self.v))
        low, high = self.distance[starts], self.distance[ends - 1]
        gap = np.maximum(np.maximum(e[:, None] - high, low - e[:, None]), 0)
        for j in np.argsort(gap.mean(0), kind="stable"):
            active = np.flatnonzero(gap[:, j] <= radius(length, bound, self.longest))
            if not len(active):
                continue
            scores = v[active] @ self.v[starts[j]:ends[j]].T
            least = bound[active]
            if scores.shape[1] > self.k:
                least = np.maximum(least, np.partition(scores, -self.k - 1, axis=1)[:, -self.k - 1])
            who, row = np.nonzero(scores >= least[:, None])
            best = tuple(np.concatenate(x) for x in zip(best, (active[who], row + starts[j], scores[who, row])))
            best, bound = self._cut(best, bound)
        return best

    def _cut(self, best: tuple, bound: np.ndarray) -> tuple[tuple, np.ndarray]:
        who, row, score = best
        order = np.lexsort([self.least[row], -score, who])
        who, row, score = who[order], row[order], score[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        keep = rank <= self.k
        full = rank == self.k
        bound[who[full]] = np.maximum(bound[who[full]], score[full])
        return (who[keep], row[keep], score[keep]), bound


def searched(index: DataFrame, queries: DataFrame, plan: Directory, k: int) -> DataFrame:
    """(a, b, score, same, ids): the best vectors of each query and shard. A task holds one shard and
    streams its queries; ``same`` marks the query's own vector."""
    schema = "a long, b long, score double, same boolean, least long, ids array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, searcher = None, [], None
        for batch in batches:
            names = np.column_stack([batch.column(c).to_numpy() for c in ("shard", "slice", "kind")])
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(names)]):
                if start == end:
                    continue
                shard, slice_, kind = names[start].tolist()
                rows = batch.slice(start, end - start)
                if (shard, slice_) != key:
                    key, parts, searcher = (shard, slice_), [], None
                if kind == 0:
                    parts.append(rows)
                    continue
                if searcher is None:
                    searcher, parts = Searcher(plan, shard, parts, k), []
                for at in range(0, rows.num_rows, TOGETHER):
                    some = rows.slice(at, TOGETHER)
                    v = matrix(some.column("v"))
                    who, row, score = searcher.search(v, some.column("bound").to_numpy())
                    own = (v * v).sum(1)[who]
                    taken = some.select(["a", "b"]).take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([
                        taken.column("a"), taken.column("b"), pa.array(score, pa.float64()),
                        pa.array((score == own) & (searcher.length[row] == own), pa.bool_()),
                        pa.array(searcher.least[row], pa.int64()), searcher.ids.take(pa.array(row))],
                        ["a", "b", "score", "same", "least", "ids"])

    rows = index.unionByName(queries).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "kind", "distance")
    return rows.mapInArrow(run, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "b").orderBy(F.desc("score"), "least")
    return found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)


def top_k(df: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding",
          shard: int = SHARD, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row whose id is divisible by ``every`` the k highest
    inner products with other rows, ties to smaller ids.

    With vectors that a pivot can't tell apart (random directions in many dimensions) no bound prunes
    and each query meets every shard: queries times rows products in matrix blocks, the same result.
    """
    rows = vectors(df, key, vector)
    entries = written(distinct_vectors(rows, k), "vectors")
    asking = rows.where(F.col("vec_id") % every == 0)
    sample = [r["v"] for r in entries.orderBy(F.xxhash64("a", "b"), "a", "b").limit(SAMPLE).select("v").collect()]
    longest = entries.agg(F.sqrt(F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, c: s + c * c)))).first()[0] or 0.0
    if not sample:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = choose_pivots(lifted(np.array(sample).reshape(len(sample), -1), longest), pivots)
    index = written(keyed(entries, points, longest), "index")
    plan = directory(index, points, longest, shard)
    queries = written(asking.select("a", "b", "v").dropDuplicates(["a", "b"]).withColumn(
        "bound", F.lit(float("-inf"))), "queries")
    slices = max(1, -(-queries.count() // SLICE))
    blocks = placed(index, plan, slices)
    near = written(searched(blocks, asked(queries, plan, slices, True), plan, k), "near")
    # With k + 1 vectors found, what scores below the last of them is out of reach.
    bound = near.groupBy("a", "b").agg(
        F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(float("-inf")).alias("bound"))
    rest = searched(blocks, asked(queries.drop("bound").join(bound, ["a", "b"]), plan, slices, False), plan, k)
    best = _best(near.union(rest), k).groupBy("a", "b").agg(
        F.collect_list(F.struct("score", "ids", "same")).alias("found"))
    # Each row leaves out one entry with its own vector and id: itself.
    flat = F.array_sort(F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct(
        (-f["score"]).alias("less"), i.alias("vec_id"), f["same"].alias("same"))))))
    mine = lambda e: e["same"] & (e["vec_id"] == F.col("query_id"))
    own = F.array_position(F.transform("all", lambda e: mine(e)), True)
    others = F.filter("all", lambda e, i: F.col("own") != i + 1)
    return (asking.select(F.col("vec_id").alias("query_id"), "a", "b").join(best, ["a", "b"])
            .withColumn("all", flat).withColumn("own", own)
            .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"),
                    (-F.col("e.less")).cast("long").alias("score")))
