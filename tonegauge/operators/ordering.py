"""Exact order statistics without a global sort in one task.

A rank or a quantile needs the rows in order.  A window without partitions, or
one per platform, would put the whole column (or the third of it that a large
platform holds) into one task, and the exact ``percentile`` aggregate keeps all
distinct values of a group in one hash map.  Here

1. equal values collapse to (value, count) with map-side partial aggregation,
   so a value shared by a third of all rows is one row;
2. cut points, four or more per shuffle partition, split the distinct values into ordered buckets of
   similar size.  The cuts are every 4th value of a bottom-k hash sample, one
   row of bounded size.  They steer the work only: results are exact for any cuts;
3. bucket totals give each bucket its starting rank;
4. only then are values sorted, inside their bucket.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = 4


def buckets(df: DataFrame) -> int:
    """A power of two, four or more per shuffle partition, so that sorting keeps all tasks busy."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(6, (4 * partitions - 1).bit_length())


def _cut_points(values: DataFrame, name: str) -> DataFrame:
    """One row: fewer ordered cut points than there are buckets."""
    # The order is any fixed pseudo-random one; limit() after it is a top-k.
    sample = (
        values.orderBy(F.xxhash64(name), name).limit(buckets(values) * _SPREAD - 1)
        .agg(F.sort_array(F.collect_list(name)).alias("_sample"))
    )
    # filter() evaluates its array once, so the sort runs once.
    every = F.filter("_sample", lambda _, i: i % _SPREAD == _SPREAD - 1)
    return sample.select(every.alias("_cuts"))


def _bucket(value: Column, n: int) -> Column:
    """Binary search of the value in the cut points; past their end get() is NULL."""
    steps = F.array(*[F.lit(n >> i) for i in range(1, n.bit_length())])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when(
            F.get("_cuts", at + step - 1) <= value, at + step).otherwise(at),
    )


def _with_bucket(counts: DataFrame, name: str) -> DataFrame:
    # The filter on a count keeps the count column in this branch as well, so both
    # branches read one and the same shuffle.
    cuts = _cut_points(counts.where("_n > 0"), name)
    return (
        counts.crossJoin(F.broadcast(cuts))  # one row of bounded size
        .withColumn("_b", _bucket(F.col(name), buckets(counts))).drop("_cuts")
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group, one output column per entry."""
    by = list(by or [])
    counts = (
        df.where(F.col(value).isNotNull())
        .where(F.lit(True) if not by else _all_known(by))
        .groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    )
    located = _with_bucket(counts, "_v")
    per_bucket = located.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per bucket and group.
    offsets = per_bucket.select(
        *by, "_b", "_bn",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_start"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("_total"),
    )
    targets = {}
    for out, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        targets[out] = (F.floor(at), F.ceil(at), at - F.floor(at))
    wanted_positions = F.array_distinct(F.array(
        *[c for lo, hi, _ in targets.values() for c in (lo, hi)]))
    # Buckets without a wanted position drop out before anything is sorted.
    wanted = offsets.withColumn(
        "_at", F.filter(wanted_positions,
                        lambda i: (i >= F.col("_start")) & (i < F.col("_start") + F.col("_bn")))
    ).where(F.size("_at") > 0)
    if not by:
        wanted = F.broadcast(wanted)  # at most two buckets per quantile
    inside = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = located.join(wanted, [*by, "_b"]).withColumn(
        "_end", F.col("_start") + F.sum("_n").over(inside))
    aggregates = []
    for out, (lo, hi, _) in targets.items():
        for side, at in (("lo", lo), ("hi", hi)):
            holds = (at < F.col("_end")) & (at >= F.col("_end") - F.col("_n"))
            aggregates.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{side}_{out}"))
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *aggregates)
    return picked.select(*by, *[
        (F.col(f"_lo_{out}") + (F.col(f"_hi_{out}") - F.col(f"_lo_{out}")) * frac).alias(out)
        for out, (_, _, frac) in targets.items()
    ])


def _all_known(names: list[str]) -> Column:
    known = F.lit(True)
    for name in names:
        known = known & F.col(name).isNotNull()
    return known


def value_ladder(df: DataFrame, value: str, group: str, groups: list[str]) -> DataFrame:
    """One row per distinct value in order, with counts and running counts.

    Columns: ``value``; ``n_i`` and ``before_i`` for the i-th group, the count at
    and strictly below the value; ``n`` and ``before`` for all groups together;
    ``avg_rank``, the mid-rank ties share.
    """
    names = [f"n_{i}" for i in range(len(groups))]
    counts = (
        df.where(F.col(value).isNotNull() & F.col(group).isin(groups))
        .groupBy(F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("_n"), *[
            F.count(F.when(F.col(group) == g, 1)).alias(c) for c, g in zip(names, groups)
        ])
    )
    located = _with_bucket(counts, "value")
    sums = ["_n", *names]
    totals = located.groupBy("_b").agg(*[F.sum(c).alias(f"_t{c}") for c in sums])
    # No more rows than buckets.
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_b", *[
        F.coalesce(F.sum(f"_t{c}").over(before), F.lit(0)).alias(f"_s{c}") for c in sums
    ])
    inside = Window.partitionBy("_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = located.join(F.broadcast(starts), "_b").select(
        "value", *sums, *[
            (F.col(f"_s{c}") + F.sum(c).over(inside) - F.col(c)).alias(f"_before{c}")
            for c in sums
        ],
    )
    return running.select(
        "value",
        F.col("_n").alias("n"), F.col("_before_n").alias("before"),
        *names, *[F.col(f"_before{c}").alias(c.replace("n_", "before_")) for c in names],
        (F.col("_before_n") + (F.col("_n") + 1) / F.lit(2.0)).alias("avg_rank"),
    )


def dense_index(names: DataFrame, name: str, out: str = "position") -> DataFrame:
    """0-based position of each distinct name in sorted order."""
    distinct = (
        names.where(F.col(name).isNotNull())
        .groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    )
    located = _with_bucket(distinct, name)
    totals = located.groupBy("_b").agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_b", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_b").orderBy(name)
    return located.join(F.broadcast(starts), "_b").select(  # a row per bucket
        name, (F.col("_start") + F.row_number().over(inside) - 1).alias(out))
