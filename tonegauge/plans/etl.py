"""The posts job: sources, checks, features, campaign join, reports, sinks."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.constants import REQUIRED_POST_COLUMNS
from tonegauge.operators import joins, posts, quality
from tonegauge.schemas import CAMPAIGNS, ENRICHED_POSTS, RAW_POSTS
from tonegauge.sources import files, sinks
from tonegauge.sources.sqlite import read_sqlite


def transform_posts(df: DataFrame) -> DataFrame:
    """All derived columns of the posts table."""
    return (
        df.transform(posts.parse_timestamp).transform(posts.add_calendar)
        .transform(posts.coerce_metrics).transform(posts.add_total_interactions)
        .transform(posts.add_recalculated_rate).transform(posts.add_engagement_flags)
        .transform(posts.flag_authentic_success).transform(posts.add_text_counts)
    )


def stamp(df: DataFrame) -> DataFrame:
    """Processing time in UTC, ISO 8601."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.withColumn(
        "etl_processed_at",
        F.concat(F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))


def choose_base(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """The enriched posts, flagged by whether the raw source has them."""
    return joins.existence_flag(enriched, raw, "post_id")


def integrate(raw: DataFrame, enriched: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Final posts: base choice, features, campaign attributes."""
    quality.required_columns(raw, REQUIRED_POST_COLUMNS, "raw")
    quality.required_columns(enriched, REQUIRED_POST_COLUMNS, "enriched")
    final = transform_posts(choose_base(raw, enriched))
    return joins.attach_campaigns(final, campaigns)


@dataclass
class PostsJob:
    """Paths of one run; optional campaign sources may be missing."""

    raw: str
    enriched: str
    campaigns_csv: str
    output: str
    campaigns_json: str | None = None
    campaigns_sqlite: str | None = None

    def campaigns(self, spark: SparkSession, base: DataFrame) -> DataFrame:
        """CSV first (made from the posts where it is missing), then JSON, then SQLite."""
        if not files.path_exists(spark, self.campaigns_csv):
            sinks.write_csv(joins.provisional_campaigns(base), self.campaigns_csv)
        sources = [("external_csv", files.read_csv(spark, self.campaigns_csv, CAMPAIGNS))]
        if self.campaigns_json and files.path_exists(spark, self.campaigns_json):
            sources.append(("api_json", files.read_json_array(spark, self.campaigns_json)))
        if self.campaigns_sqlite and files.path_exists(spark, self.campaigns_sqlite):
            sources.append(("sqlite", read_sqlite(spark, self.campaigns_sqlite)))
        return joins.latest_metadata(joins.union_sources(sources))

    def run(self, spark: SparkSession) -> DataFrame:
        raw = files.read_csv(spark, self.raw, RAW_POSTS, "raw_csv")
        enriched = files.read_csv(spark, self.enriched, ENRICHED_POSTS, "enriched_csv")
        final = stamp(integrate(raw, enriched, self.campaigns(spark, enriched)))
        sinks.write_table(final, f"{self.output}/posts")
        # Reports and the CSV copy read the written table, not the sources again.
        written = spark.read.parquet(f"{self.output}/posts")
        sinks.write_csv(written, f"{self.output}/posts_csv")
        sinks.write_csv(quality.quality_report(written), f"{self.output}/quality_report")
        sinks.write_report(quality.run_summary(written), f"{self.output}/summary")
        return written
