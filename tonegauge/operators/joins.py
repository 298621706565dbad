"""Joins, unions and de-duplication."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonegauge.constants import (
    CAMPAIGN_BUDGET, CAMPAIGN_OBJECTIVES, CAMPAIGN_PRIORITIES, CAMPAIGN_SEGMENTS,
    CAMPAIGN_SOURCE_TYPE,
)
from tonegauge.operators.ordering import dense_index

def attach_campaigns(
    posts: DataFrame, campaigns: DataFrame, key: str = "campaign_name"
) -> DataFrame:
    """Left join in which a missing campaign matches a missing campaign."""
    dim = campaigns.withColumnRenamed(key, "_key")
    return posts.join(dim, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def existence_flag(
    base: DataFrame, other: DataFrame, key: str, out: str = "exists_in_raw_source",
    other_key: str | None = None,
) -> DataFrame:
    """Is the key among the ids of the other source?  A flag, no rows added."""
    ids = (
        other.select(F.col(other_key or key).alias("_id"))
        .where(F.col("_id").isNotNull()).distinct().withColumn("_found", F.lit(True))
    )
    return (
        base.join(ids, F.col(key) == F.col("_id"), "left")
        .withColumn(out, F.coalesce("_found", F.lit(False))).drop("_id", "_found")
    )


def missing_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids of the left source that the right one lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def union_sources(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Stack sources by column name, later ones with higher priority."""
    tagged = [
        df.withColumns({"metadata_source": F.lit(label), "source_priority": F.lit(i)})
        for i, (label, df) in enumerate(sources)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Written as row_number() = 1, for which Spark drops all but the first row of
    a key in each map task before the shuffle, so copies of a hot key never meet.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last one; ``order`` is given in descending form."""
    return keep_first(df, keys, order)


def dedup_comments(df: DataFrame, sequence: str) -> DataFrame:
    """One row per comment after dropping rows without id, platform or score."""
    known = df.na.drop(subset=["comment_id", "platform", "hate_speech_score"])
    return keep_first(known, ["comment_id"], [F.col(sequence).asc()])


def latest_metadata(stacked: DataFrame, sequence: list[Column] | None = None) -> DataFrame:
    """The last source wins for each campaign.

    Files have no row order; repeats inside one source are settled by their values
    unless a sequence is given, so that every run keeps the same row.
    """
    others = sorted(set(stacked.columns) - {"source_priority", "campaign_name"})
    order = [F.col("source_priority").desc(), *(sequence or [F.col(c).desc() for c in others])]
    return keep_last(stacked, ["campaign_name"], order).drop("source_priority")


def provisional_campaigns(posts: DataFrame) -> DataFrame:
    """Campaign dimension built from the sorted distinct names."""
    base, step, modulus = CAMPAIGN_BUDGET
    index = dense_index(posts.select("campaign_name"), "campaign_name", "i")
    i = F.col("i")

    def cycle(values: list[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), (i % len(values)).cast("int"))

    return index.select(
        "campaign_name",
        cycle(CAMPAIGN_OBJECTIVES).alias("campaign_objective"),
        cycle(CAMPAIGN_SEGMENTS).alias("target_segment"),
        (base + (i * step) % modulus).cast("int").alias("planned_budget_usd"),
        cycle(CAMPAIGN_PRIORITIES).alias("priority_level"),
        F.lit(CAMPAIGN_SOURCE_TYPE).alias("external_source_type"),
    )


def keep_platforms(df: DataFrame, name: str, allowed: list) -> DataFrame:
    """Membership filter that the scan can evaluate."""
    return df.where(F.col(name).isin(allowed))


def align_models(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Two model outputs over the same items, aligned by id."""
    return first.join(second, key)
