"""Descriptive statistics, shares and cross tables.

Plain aggregates combine on the map side, so a group with a third of all rows
reaches its reducer as one partial row per task.  Quantiles come from
``ordering``, never from an aggregate that holds a whole group.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonegauge.constants import TOXIC_THRESHOLD
from tonegauge.functions.labels import in_order
from tonegauge.operators.ordering import exact_quantiles


def join_on_groups(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Join two per-group tables; without groups both are one row."""
    return left.join(right, by) if by else left.crossJoin(F.broadcast(right))


def _rounded(df: DataFrame, names: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


def score_summary(df: DataFrame, group: str, score: str, digits: int = 4) -> DataFrame:
    """A1: n, mean, median, std, min and max per group."""
    known = df.where(F.col(group).isNotNull() & F.col(score).isNotNull())
    basics = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"), F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
    middle = exact_quantiles(known, score, {"median": 0.5}, [group])
    out = basics.join(middle, group).select(group, "n", "mean", "median", "std", "min", "max")
    return _rounded(out, ["mean", "median", "std", "min", "max"], digits)


def score_distribution(
    df: DataFrame, group: str, score: str, threshold: float = TOXIC_THRESHOLD, digits: int = 4
) -> DataFrame:
    """A2: A1 with quartiles, the 95th percentile and the mean without the tail."""
    known = df.where(F.col(group).isNotNull() & F.col(score).isNotNull())
    basics = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"), F.max(score).alias("max"),
        F.avg(F.when(F.col(score) <= threshold, F.col(score))).alias("mean_sin_cola"),
    )
    levels = exact_quantiles(
        known, score, {"median": 0.5, "q25": 0.25, "q75": 0.75, "q95": 0.95}, [group])
    names = ["mean", "median", "std", "q25", "q75", "q95", "max", "mean_sin_cola"]
    return _rounded(basics.join(levels, group).select(group, "n", *names), names, digits)


def threshold_share(
    df: DataFrame, group: str, score: str, threshold: float = TOXIC_THRESHOLD
) -> DataFrame:
    """A3: rows strictly above the threshold and their share in percent."""
    over = F.count(F.when(F.col(score) > threshold, 1))
    n = F.count(F.lit(1))
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        n.alias("n"), over.alias("n_toxicos"),
        F.round(F.lit(100.0) * over / n, 2).alias("pct_toxicos"),
    )


def mean_ranking(df: DataFrame, group: str, score: str) -> DataFrame:
    """A4: groups by mean score, most toxic first (4-digit means decide)."""
    return (
        df.where(F.col(group).isNotNull()).groupBy(group)
        .agg(F.round(F.avg(score), 4).alias("score_medio"))
        .orderBy(F.col("score_medio").desc(), group)
    )


def ranking_reading(ranking: DataFrame, group: str, suspect: str) -> DataFrame:
    """A4: one row that reads the ranking; ties go to the first name."""
    top = F.min_by(F.col(group), F.struct(-F.col("score_medio"), F.col(group)))
    bottom = F.max_by(F.col(group), F.struct(-F.col("score_medio"), F.col(group)))
    return ranking.agg(
        top.alias("most_toxic_platform"), bottom.alias("least_toxic_platform"),
        F.every(F.col("score_medio") < 0).alias("all_means_negative"),
        (top == F.lit(suspect)).alias("hypothesis_confirmed"),
    )


def three_digits(value: Column) -> Column:
    """A number with three decimals, rounded from its exact binary value as C's printf does.

    ``format_string`` rounds the shortest decimal form half up instead: 50.2945 is a little
    less than it reads.  ``format_number`` misses one tie, 0.0005, which lies above it.
    """
    exact = F.when(F.abs(value) == 0.0005, value * 1.5).otherwise(value)
    return F.call_function("format_number", exact, F.lit("0.000"))


def relative_index(ranking: DataFrame, group: str) -> DataFrame:
    """Distance to the least toxic group and a readable label."""
    floor = ranking.agg(F.min("score_medio").alias("_floor"))
    return ranking.crossJoin(F.broadcast(floor)).select(  # one row
        group, "score_medio",
        F.round(F.col("score_medio") - F.col("_floor"), 4).alias("toxicidad_relativa"),
        F.concat(F.col(group), F.lit(" ("), three_digits(F.col("score_medio")), F.lit(")")).alias("lectura"),
    )


def tail_reading(distribution: DataFrame) -> DataFrame:
    """Is it the tail, not the average, that separates the groups?"""
    return distribution.agg(
        F.round(F.max("median") - F.min("median"), 4).alias("median_range"),
        F.round(F.max("q95") - F.min("q95"), 4).alias("q95_range"),
        ((F.max("q95") - F.min("q95")) > (F.max("median") - F.min("median")))
        .alias("tail_not_average"),
    )


def value_counts(df: DataFrame, name: str, digits: int = 2) -> DataFrame:
    """Rows per known value and their share in percent."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(  # one row
        name, "n", F.round(F.lit(100.0) * F.col("n") / F.col("_total"), digits).alias("pct"))


def fake_volume(df: DataFrame, flag: str = "fake_engagement_flag") -> DataFrame:
    """Posts, flagged, organic and shares."""
    n, fake = F.count(F.lit(1)), F.sum(F.col(flag).cast("bigint"))
    return df.agg(
        n.alias("posts"), fake.alias("fake"), (n - fake).alias("organic"),
        F.round(F.lit(100.0) * fake / n, 1).alias("fake_pct"),
        F.round(F.lit(100.0) * (n - fake) / n, 1).alias("organic_pct"),
    )


def share_by(df: DataFrame, group: str, flag: str, out: str, digits: int = 4) -> DataFrame:
    """Share of a 0/1 flag per group, in percent."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.round(F.avg(flag) * 100, digits).alias(out))


def mean_by(df: DataFrame, group: str, names: list[str], digits: int = 4) -> DataFrame:
    """Means of several measures per group."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.round(F.avg(c), digits).alias(c) for c in names])


def executive_kpis(df: DataFrame) -> DataFrame:
    """Posts, platforms, campaigns, share of authentic success, mean engagement.

    Distinct platforms and campaigns come from one grouping on both, so the big
    table is aggregated once with map-side combination.
    """
    cells = df.groupBy("platform", "campaign_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("authentic_success").cast("double")).alias("hits"),
        F.sum("engagement_rate").alias("rate"), F.count("engagement_rate").alias("rated"),
    )
    return cells.agg(
        F.sum("n").alias("posts"), F.count_distinct("platform").alias("platforms"),
        F.count_distinct("campaign_name").alias("campaigns"),
        F.round(F.sum("hits") / F.sum("n") * 100, 1).alias("authentic_pct"),
        F.round(F.sum("rate") / F.sum("rated"), 3).alias("mean_engagement"),
    )


def box_stats(df: DataFrame, group: str, score: str, digits: int = 4) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outlier count per group."""
    known = df.where(F.col(group).isNotNull() & F.col(score).isNotNull())
    quartiles = exact_quantiles(known, score, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    value = F.col(score)
    # One row per distinct (group, score): whiskers need no copies of a value.
    cells = known.groupBy(group, score).agg(F.count(F.lit(1)).alias("_n"))
    whiskers = cells.join(quartiles, group).groupBy(group).agg(
        *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(value >= low, value)).alias("whisker_low"),
        F.max(F.when(value <= high, value)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((value < low) | (value > high), F.col("_n"))), F.lit(0))
        .alias("outliers"),
    )
    return _rounded(whiskers, ["q1", "median", "q3", "whisker_low", "whisker_high"], digits)


def crosstab(
    df: DataFrame, row: str, col: str, values: list[str], normalise: bool = False, digits: int = 2
) -> DataFrame:
    """Counts, or shares of the row, with a fixed column list."""
    known = df.where(F.col(row).isNotNull() & F.col(col).isin(values))
    counts = known.groupBy(row).agg(*[
        F.count(F.when(F.col(col) == v, 1)).alias(str(v)) for v in values])
    if not normalise:
        return counts
    total = sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`"))
    return counts.select(row, *[
        F.round(F.try_divide(F.col(f"`{v}`").cast("double"), total.cast("double")), digits)
        .alias(str(v)) for v in values])


def melt(df: DataFrame, ids: list[str], names: list[str], variable: str, value: str) -> DataFrame:
    """Wide metrics to long."""
    return df.unpivot(ids, names, variable, value)


def label_ranges(df: DataFrame, label: str, score: str, digits: int = 3) -> DataFrame:
    """V9: score range per label; ranges that do not overlap show leakage."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.round(F.min(score), digits).alias("min"),
        F.round(F.max(score), digits).alias("max"),
    )


def ordered_categories(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Rows in a fixed category order, with the position as a column."""
    position = in_order(F.col(name), order)
    return df.withColumn("position", position).orderBy("position", name)


def name_clusters(profile: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """Cluster type by its mean coherence."""
    coherent: Column = F.col("coherencia_sentimiento") > cutoff
    return profile.withColumn(
        "tipo", F.when(coherent, "Coherente").otherwise("Incoherente"))
