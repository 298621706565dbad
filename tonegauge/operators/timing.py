"""Publishing-time reports over the organic posts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonegauge.constants import WEEKDAYS


def hour_profile(df: DataFrame) -> DataFrame:
    """Mean reach, mean engagement and counted posts per hour (24 rows)."""
    return df.where(F.col("hora").isNotNull()).groupBy("hora").agg(
        F.avg("impressions").alias("imp_media"),
        F.avg("engagement_rate").alias("eng_media"),
        F.count("impressions").alias("n_posts"),
    )


def hour_zones(profile: DataFrame) -> DataFrame:
    """Each hour against the unweighted mean of the hours."""
    limits = profile.agg(
        F.avg("imp_media").alias("_imp"), F.avg("eng_media").alias("_eng"))
    reach, react = F.col("imp_media") > F.col("_imp"), F.col("eng_media") > F.col("_eng")
    zone = (
        F.when(reach & react, "sweet_spot").when(reach, "alto_alcance")
        .when(react, "alto_engagement").otherwise("bajo")
    )
    return profile.crossJoin(F.broadcast(limits)).withColumn("zona", zone).drop("_imp", "_eng")


def day_profile(df: DataFrame) -> DataFrame:
    """Means per weekday in calendar order; a day without posts stays, empty."""
    spark = df.sparkSession
    days = spark.createDataFrame(list(enumerate(WEEKDAYS)), "position int, dia_semana string")
    means = df.where(F.col("dia_semana").isNotNull()).groupBy("dia_semana").agg(
        F.avg("impressions").alias("imp_media"),
        F.avg("engagement_rate").alias("eng_media"),
    )
    return days.join(F.broadcast(means), "dia_semana", "left").orderBy("position")  # 7 rows


def day_hour_profile(df: DataFrame) -> DataFrame:
    """Mean reach per weekday and hour (at most 168 rows)."""
    known = df.where(F.col("dia_semana").isNotNull() & F.col("hora").isNotNull())
    return known.groupBy("dia_semana", "hora").agg(F.avg("impressions").alias("impressions"))


def top_rows(df: DataFrame, measure: str, keys: list[str], n: int = 5) -> DataFrame:
    """O2: the n largest, ties by key."""
    return df.orderBy(F.col(measure).desc(), *keys).limit(n)


def best_hours(profile: DataFrame) -> DataFrame:
    """O3: the hour with most reach and with most engagement; ties to the earlier hour."""
    def at_most(measure: str):
        return F.max_by("hora", F.struct(F.col(measure), -F.col("hora")))

    return profile.agg(
        at_most("imp_media").alias("hora_max_imp"), F.max("imp_media").alias("imp_max"),
        at_most("eng_media").alias("hora_max_eng"), F.max("eng_media").alias("eng_max"),
    )
