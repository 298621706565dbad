"""Pearson correlation, overall and per platform."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.functions.special import pearson_p


def correlations(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """R, p and n for the whole table and each group, in one pass."""
    known = df.where(F.col(group).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
    return (
        known.rollup(group)
        .agg(F.grouping(group).alias("_all"), F.corr(x, y).alias("_r"),
             F.count(F.lit(1)).alias("n"))
        .select(
            F.when(F.col("_all") == 1, "overall").otherwise(F.col(group)).alias("scope"),
            F.round("_r", 4).alias("r"),
            pearson_p(F.col("_r"), F.col("n").cast("double")).alias("p_value"), "n")
    )


def consistency(correlation: DataFrame, margin: float = 0.1) -> DataFrame:
    """Do the platforms agree?  Rounded correlations decide."""
    return correlation.where(F.col("scope") != "overall").agg(
        F.min("r").alias("r_min"), F.max("r").alias("r_max"),
        ((F.max("r") - F.min("r")) < margin).alias("consistent_across_platforms"),
    )
