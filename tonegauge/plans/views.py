"""The posts, comments and texts that the queries run on, as views of the given tables.

Every view exists twice, as a DataFrame and as a SQL common table expression with
the same expressions, so that a query and its SQL check start from equal rows.
All views keep every row of their table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.functions.labels import tone_from_score


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: list[str], index):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


EMOTIONS = ["Angry", "Confused", "Excited", "Happy", "Sad"]
PHASES = ["Launch", "Post-Launch", "Pre-Launch"]


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """The 28-column posts table over ``events``."""
    e = table(spark, sf, "events")
    key, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    score = (k - 50).cast("double") / F.lit(50.0)
    return e.select(
        key.cast("string").alias("post_id"),
        F.col("ts").alias("timestamp"),
        F.date_format(F.col("ts").cast("timestamp"), "EEEE").alias("day_of_week"),
        F.col("event_type").alias("platform"),
        user.cast("string").alias("user_id"),
        F.concat(F.lit("City"), user % 33).alias("location"),
        F.concat(F.lit("L"), user % 10).alias("language"),
        F.concat(
            F.lit("Great "), F.col("event_type"), F.lit(" by user "), user, F.lit(" rated "), k,
            F.when(k % 4 == 0, "! worst").when(k % 4 == 1, "?").otherwise(""),
        ).alias("text_content"),
        F.when(k % 10 == 0, "").otherwise(
            F.concat(F.lit("#"), F.col("event_type"), F.lit(",#k"), k % 10)).alias("hashtags"),
        F.when(user % 3 != 0, F.concat(F.lit("@u"), user)).alias("mentions"),
        F.concat(F.col("event_type"), F.lit(","), k).alias("keywords"),
        F.concat(F.lit("Topic"), k % 6).alias("topic_category"),
        score.alias("sentiment_score"),
        tone_from_score(score).alias("sentiment_label"),
        _pick(EMOTIONS, k % 5).alias("emotion_type"),
        (((key * 7919) % 1000).cast("double") / F.lit(1000.0)).alias("toxicity_score"),
        F.floor(value).cast("double").alias("likes_count"),
        k.cast("double").alias("shares_count"),
        (key % 7).alias("comments_count"),
        ((key * 31) % 9973).alias("impressions"),
        (value / F.lit(100.0)).alias("engagement_rate"),
        F.concat(F.lit("Brand"), user % 10).alias("brand_name"),
        F.concat(F.lit("Product"), user % 70).alias("product_name"),
        F.concat(F.lit("C"), key % 23).alias("campaign_name"),
        _pick(PHASES, key % 3).alias("campaign_phase"),
        (((user * 37) % 200 - 100).cast("double") / F.lit(100.0)).alias("user_past_sentiment_avg"),
        (((key * 53) % 400 - 200).cast("double") / F.lit(100.0)).alias("user_engagement_growth"),
        (((key * 17) % 1000 - 500).cast("double") / F.lit(10.0)).alias("buzz_change_rate"),
    )


POSTS = """
kposts AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events
), posts AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id, ts AS "timestamp",
    strftime(ts, '%A') AS day_of_week, event_type AS platform,
    CAST(user_id AS VARCHAR) AS user_id, 'City' || (user_id % 33) AS location,
    'L' || (user_id % 10) AS language,
    'Great ' || event_type || ' by user ' || user_id || ' rated ' || k ||
      CASE WHEN k % 4 = 0 THEN '! worst' WHEN k % 4 = 1 THEN '?' ELSE '' END AS text_content,
    CASE WHEN k % 10 = 0 THEN '' ELSE '#' || event_type || ',#k' || (k % 10) END AS hashtags,
    CASE WHEN user_id % 3 <> 0 THEN '@u' || user_id END AS mentions,
    event_type || ',' || k AS keywords, 'Topic' || (k % 6) AS topic_category,
    CAST(k - 50 AS DOUBLE) / 50e0 AS sentiment_score,
    CASE WHEN CAST(k - 50 AS DOUBLE) / 50e0 < -0.2e0 THEN 'Negative'
         WHEN CAST(k - 50 AS DOUBLE) / 50e0 > 0.2e0 THEN 'Positive'
         ELSE 'Neutral' END AS sentiment_label,
    ['Angry', 'Confused', 'Excited', 'Happy', 'Sad'][k % 5 + 1] AS emotion_type,
    CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000e0 AS toxicity_score,
    CAST(floor(value) AS DOUBLE) AS likes_count, CAST(k AS DOUBLE) AS shares_count,
    event_id % 7 AS comments_count, (event_id * 31) % 9973 AS impressions,
    value / 100e0 AS engagement_rate, 'Brand' || (user_id % 10) AS brand_name,
    'Product' || (user_id % 70) AS product_name, 'C' || (event_id % 23) AS campaign_name,
    ['Launch', 'Post-Launch', 'Pre-Launch'][event_id % 3 + 1] AS campaign_phase,
    CAST((user_id * 37) % 200 - 100 AS DOUBLE) / 100e0 AS user_past_sentiment_avg,
    CAST((event_id * 53) % 400 - 200 AS DOUBLE) / 100e0 AS user_engagement_growth,
    CAST((event_id * 17) % 1000 - 500 AS DOUBLE) / 10e0 AS buzz_change_rate
  FROM kposts
)"""


def text_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts with real text: ``documents`` with the labels that exist."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    text = F.col("text")
    tags = F.concat_ws(",", F.regexp_extract_all(text, F.lit(r"#[A-Za-z0-9_]+"), F.lit(0)))
    names = F.concat_ws(",", F.regexp_extract_all(text, F.lit(r"@[A-Za-z0-9_]+"), F.lit(0)))
    return d.join(l, "doc_id", "left").select(
        F.col("doc_id").alias("post_id"), text.alias("text_content"),
        F.col("lang").alias("language"), F.col("source").alias("brand_name"),
        tags.alias("hashtags"), F.when(names != "", names).alias("mentions"),
        "n_chars", "quality", "toxic",
    )


TEXT_POSTS = r"""
text_posts AS (
  SELECT d.doc_id AS post_id, text AS text_content, lang AS language, source AS brand_name,
    array_to_string(regexp_extract_all(text, '#[A-Za-z0-9_]+'), ',') AS hashtags,
    nullif(array_to_string(regexp_extract_all(text, '@[A-Za-z0-9_]+'), ','), '') AS mentions,
    n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """The comment corpus over ``conversations``: one row per annotator turn."""
    c = table(spark, sf, "conversations")
    return c.select(
        F.col("conv_id").alias("comment_id"), F.col("turn").alias("annotator"), "text",
        (F.col("conv_id") % 4).cast("int").alias("platform"),
        ((F.length("text") % 97).cast("double") / F.lit(20.0) - F.lit(2.0))
        .alias("hate_speech_score"),
        ((F.col("conv_id") % 13).cast("double") / F.lit(4.0)).alias("sentiment"),
    )


COMMENTS = """
comments AS (
  SELECT conv_id AS comment_id, turn AS annotator, text, CAST(conv_id % 4 AS INTEGER) AS platform,
    CAST(length(text) % 97 AS DOUBLE) / 20e0 - 2e0 AS hate_speech_score,
    CAST(conv_id % 13 AS DOUBLE) / 4e0 AS sentiment
  FROM conversations
), named_comments AS (
  SELECT *, CASE platform WHEN 0 THEN 'reddit' WHEN 2 THEN 'twitter' WHEN 3 THEN 'youtube' END
    AS platform_name
  FROM comments WHERE platform IN (0, 2, 3)
)"""


PLATFORMS = ["click", "error", "purchase", "signup", "view"]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scores per platform over ``events``: many ties, five groups."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("comment_id"), F.col("event_type").alias("platform"),
        F.col("value").alias("score"))


SCORED = "scored AS (SELECT event_id AS comment_id, event_type AS platform, value AS score FROM events)"


def two_models(spark: SparkSession, sf: str) -> DataFrame:
    """Truth and two predictions per item over ``labels`` and ``documents``."""
    l, d = table(spark, sf, "labels"), table(spark, sf, "documents")
    return l.join(d.select("doc_id", "n_chars", "lang"), "doc_id").select(
        F.col("doc_id").alias("item_id"), F.col("quality").cast("string").alias("true_label"),
        F.col("toxic").cast("string").alias("model_a"),
        F.when(F.col("n_chars") > 1000, "1").otherwise("0").alias("model_b"),
        F.col("lang").alias("language"),
    )


TWO_MODELS = """
two_models AS (
  SELECT l.doc_id AS item_id, CAST(quality AS VARCHAR) AS true_label,
    CAST(toxic AS VARCHAR) AS model_a, CASE WHEN n_chars > 1000 THEN '1' ELSE '0' END AS model_b,
    lang AS language
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views) + "\n"
