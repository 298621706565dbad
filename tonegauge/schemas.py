"""Explicit schemas of the inputs; production reads never infer."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "int": T.IntegerType(), "timestamp": T.TimestampType(),
}


def columns(listing: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike DDL parsing it needs no session."""
    pairs = [pair.split() for pair in listing.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


RAW_POSTS = columns("""
    post_id string, timestamp timestamp, day_of_week string, platform string,
    user_id string, location string, language string, text_content string,
    hashtags string, mentions string, keywords string, topic_category string,
    sentiment_score double, sentiment_label string, emotion_type string,
    toxicity_score double, likes_count double, shares_count double,
    comments_count bigint, impressions bigint, engagement_rate double,
    brand_name string, product_name string, campaign_name string,
    campaign_phase string, user_past_sentiment_avg double,
    user_engagement_growth double, buzz_change_rate double
""")

ENRICHED_POSTS = T.StructType(RAW_POSTS.fields + columns("""
    total_interactions double, er_recalc double, toxicity_bin string,
    er_normalized double, composite_score double, er_segment string,
    country_extracted string, country_norm string, platform_norm string,
    year bigint, month bigint, hour bigint
""").fields)

CAMPAIGNS = columns("""
    campaign_name string, campaign_objective string, target_segment string,
    planned_budget_usd int, priority_level string, external_source_type string
""")

COMMENTS = columns("""
    comment_id bigint, text string, platform int, hate_speech_score double,
    sentiment double, respect double, insult double, humiliate double,
    status double, dehumanize double, violence double, genocide double,
    attack_defend double, hatespeech double
""")

LABELLED_TEXT = columns("text_content string, sentiment_label string")


def all_text(schema: T.StructType) -> T.StructType:
    """The same columns read as strings, for sources whose values need coercion."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def schema_drift(spark: SparkSession, df: DataFrame, contract: T.StructType) -> DataFrame:
    """One row per missing, extra or retyped column.  Reads the schema only."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    rows = [(c, "missing", want[c], None) for c in want if c not in have]
    rows += [(c, "extra", None, have[c]) for c in have if c not in want]
    rows += [
        (c, "type", want[c], have[c])
        for c in want if c in have and want[c] != have[c]
    ]
    return spark.createDataFrame(
        rows, "column string, issue string, expected string, found string"
    )
