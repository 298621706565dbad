"""Repeatable samples, splits and folds.

The order is the md5 of the row id, so the same rows are chosen on any cluster
and after any retry.  Positions inside a class are exact although no task ever
holds a class: the key's leading digits split each class into equal buckets, the
bucket counts give each bucket its starting position.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonegauge.constants import SEED
from tonegauge.functions.hashing import bucket_of, shuffle_key, uniform



def digits(df: DataFrame) -> int:
    """Hex digits that cut every class into sixteen buckets or more per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, math.ceil(math.log(16 * partitions, 16)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """N rows without replacement."""
    return df.orderBy(shuffle_key(F.col(key), seed), key).limit(n)


def shuffled_position(df: DataFrame, key: str, label: str | None, seed: int = SEED) -> DataFrame:
    """Adds ``_pos`` (0-based place of the row in its class) and ``_size``.

    Counts and rows are joined on (class, bucket), the partitioning the window
    needs as well, so the rows are shuffled once.
    """
    by = [label] if label else []
    keyed = df.withColumn("_key", shuffle_key(F.col(key), seed)).withColumn(
        "_bucket", bucket_of(F.col("_key"), digits(df)))
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 16**digits rows per class.
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_size"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_key", key)
    return (
        keyed.join(starts, [*by, "_bucket"])
        .withColumn("_pos", F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_key", "_bucket", "_start")
    )


def _rounded_share(fraction: float) -> Column:
    return F.floor(F.col("_size") * F.lit(fraction) + 0.5)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Exact test share of every class; adds ``is_test``."""
    known = df.where(F.col(label).isNotNull())
    placed = shuffled_position(known, key, label, seed)
    return placed.withColumn("is_test", F.col("_pos") < _rounded_share(test)).drop("_pos", "_size")


def split_rows(
    df: DataFrame, key: str, label: str, test: float = 0.2, seed: int = SEED
) -> DataFrame:
    """``stratified_split`` of wide rows, which stay where they are.

    Keys and classes alone are shuffled, to find the key where each class is cut (two rows per
    class reach the driver); every row is then compared with the cut of its class. Where equal keys
    stand on both sides of a cut, positions must tell them apart.
    """
    known = df.where(F.col(label).isNotNull())
    share, order = _rounded_share(test), shuffle_key(F.col(key), seed)
    near = shuffled_position(known.select(key, label), key, label, seed).where(
        F.col("_pos").between(share - 1, share)).select(
        F.col(label).alias("c"), order.alias("k"), (F.col("_pos") < share).alias("before")).collect()
    last = {r["c"]: r["k"] for r in near if r["before"]}
    cuts = {r["c"]: r["k"] for r in near if not r["before"]}
    if any(last.get(c) == k for c, k in cuts.items()):
        return stratified_split(df, key, label, test, seed)
    if not cuts:
        return known.withColumn("is_test", F.lit(True))
    cut = F.create_map(*[F.lit(v) for pair in cuts.items() for v in pair])[F.col(label)]
    # A class without a cut is all test; no hex digit reaches 'g'.
    return known.withColumn("is_test", order < F.coalesce(cut, F.lit("g")))


def folds(
    df: DataFrame, key: str, k: int, label: str | None = None, seed: int = SEED
) -> DataFrame:
    """Fold number; with a label every class is dealt out evenly."""
    known = df.where(F.col(label).isNotNull()) if label else df
    placed = shuffled_position(known, key, label, seed)
    return placed.withColumn("fold", F.pmod("_pos", F.lit(k)).cast("int")).drop("_pos", "_size")


def first_per_label(df: DataFrame, label: str, key: str, n: int = 2) -> DataFrame:
    """The first n rows of each label in key order."""
    window = Window.partitionBy(label).orderBy(key)
    known = df.where(F.col(label).isNotNull())
    return known.withColumn("row", F.row_number().over(window)).where(F.col("row") <= n)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """N / (classes x class size), joined to the rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_classes"))
    weights = counts.crossJoin(F.broadcast(totals)).select(  # one row
        label, (F.col("_rows") / (F.col("_classes") * F.col("_n"))).alias(out))
    return df.join(weights, label)


def majority_class(train: DataFrame, label: str) -> DataFrame:
    """The most frequent class, ties alphabetically; one row."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.min_by(label, F.struct(-F.col("_n"), F.col(label))).alias("prediction"))


def random_by_prior(
    train: DataFrame, test: DataFrame, key: str, label: str, seed: int = SEED
) -> DataFrame:
    """Predictions drawn from the training prior, repeatable per row id.

    The prior is one row holding the classes and their cumulative shares.
    """
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, 0)  # a row per class
    shares = counts.select(
        F.col(label).alias("_label"),
        (F.sum("_n").over(upto) / F.sum("_n").over(Window.partitionBy())).alias("_upto"))
    prior = shares.agg(F.sort_array(F.collect_list(F.struct("_upto", "_label"))).alias("_prior"))
    draw = uniform(shuffle_key(F.col(key), seed))
    chosen = F.get(F.filter("_prior", lambda c: c["_upto"] > F.col("_draw")), F.lit(0))
    return (
        test.withColumn("_draw", draw).crossJoin(F.broadcast(prior))
        .withColumn("prediction", chosen["_label"]).drop("_draw", "_prior")
    )
