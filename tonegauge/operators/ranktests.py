"""Kruskal-Wallis, Mann-Whitney and Holm over any number of rows.

All sums come from one pass over the value ladder (``ordering.value_ladder``), so
the groups themselves are never sorted or collected.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonegauge.functions.special import chi2_p, normal_p
from tonegauge.operators.ordering import value_ladder


def _num(name: str) -> Column:
    """Counts as doubles: their products exceed a bigint on large tables."""
    return F.col(name).cast("double")


def kruskal_wallis(df: DataFrame, value: str, group: str, groups: list[str]) -> DataFrame:
    """H with tie correction, p and the decision at 5 %."""
    ladder = value_ladder(df, value, group, groups)
    k = len(groups)
    n = _num("n")
    sums = ladder.agg(
        F.sum(n).alias("N"), F.sum(n * n * n - n).alias("ties"),
        *[F.sum(_num(f"n_{i}")).alias(f"N_{i}") for i in range(k)],
        *[F.sum(_num(f"n_{i}") * F.col("avg_rank")).alias(f"R_{i}") for i in range(k)],
    )
    total = F.col("N")
    # A group without rows has rank sum 0 and adds nothing.
    parts = sum(
        (F.coalesce(F.try_divide(F.col(f"R_{i}") * F.col(f"R_{i}"), F.col(f"N_{i}")), F.lit(0.0))
         for i in range(k)), F.lit(0.0))
    used = sum((F.when(F.col(f"N_{i}") > 0, 1).otherwise(0) for i in range(k)), F.lit(0))
    raw = 12.0 / (total * (total + 1)) * parts - 3 * (total + 1)
    correction = 1 - F.col("ties") / (total * total * total - total)
    return (
        sums.where(total > 1)
        .select(
            used.alias("groups"), total.cast("bigint").alias("n"),
            F.try_divide(raw, correction).alias("h_statistic"))
        .withColumn("p_value", chi2_p(F.col("h_statistic"), (F.col("groups") - 1).cast("double")))
        .withColumn("significant_0_05", F.col("p_value") < 0.05)
    )


def mann_whitney(df: DataFrame, value: str, group: str, groups: list[str]) -> DataFrame:
    """U of the first group of each pair, two-sided normal p.

    Ties and continuity are corrected as in the usual asymptotic test.
    """
    ladder = value_ladder(df, value, group, groups)
    pairs = list(combinations(range(len(groups)), 2))
    aggregates = [F.sum(_num(f"n_{i}")).alias(f"N_{i}") for i in range(len(groups))]
    for i, j in pairs:
        below = _num(f"before_{j}") + _num(f"n_{j}") / 2
        tied = _num(f"n_{i}") + _num(f"n_{j}")
        aggregates += [
            F.sum(_num(f"n_{i}") * below).alias(f"U_{i}_{j}"),
            F.sum(tied * tied * tied - tied).alias(f"T_{i}_{j}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(groups[i]).alias("group_a"), F.lit(groups[j]).alias("group_b"),
            F.col(f"N_{i}").alias("n_a"), F.col(f"N_{j}").alias("n_b"),
            F.col(f"U_{i}_{j}").alias("u"), F.col(f"T_{i}_{j}").alias("ties"))
        for i, j in pairs
    ])
    table = ladder.agg(*aggregates).select(F.inline(rows))
    total = F.col("n_a") + F.col("n_b")
    spread = F.sqrt(
        F.col("n_a") * F.col("n_b") / 12
        * (total + 1 - F.col("ties") / (total * (total - 1))))
    centre = F.col("n_a") * F.col("n_b") / 2
    z = F.try_divide(F.abs(F.col("u") - centre) - 0.5, spread)
    return (
        table.where((F.col("n_a") > 0) & (F.col("n_b") > 0))
        .select(
            "group_a", "group_b", F.col("n_a").cast("bigint").alias("n_a"),
            F.col("n_b").cast("bigint").alias("n_b"), F.col("u").alias("u_statistic"),
            z.alias("z"))
        # Below half a step from the centre the tail passes one half: p is 1.
        .withColumn("p_value", F.when(F.col("z") <= 0, F.lit(1.0)).otherwise(normal_p("z")))
    )


def holm(tests: DataFrame, p: str = "p_value", keys: list[str] | None = None) -> DataFrame:
    """Step-down adjusted p, monotone and at most 1.

    The input is one row per pair of groups, a handful; the window runs on those.
    """
    ordered = Window.orderBy(p, *(keys or ["group_a", "group_b"]))
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    remaining = F.count(F.lit(1)).over(Window.partitionBy()) - F.row_number().over(ordered) + 1
    stepped = tests.withColumn("_adj", F.least(F.lit(1.0), remaining * F.col(p)))
    return (
        stepped.withColumn("p_value_holm", F.max("_adj").over(upto)).drop("_adj")
        .withColumn("significant_holm_0_05", F.col("p_value_holm") < 0.05)
    )
