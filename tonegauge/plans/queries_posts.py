"""Registered queries: sources, checks, projections and joins over posts."""

import uuid

from pyspark.sql import functions as F

from tonegauge import constants as K
from tonegauge.functions import labels, text
from tonegauge.functions.coerce import flag, to_number
from tonegauge.operators import describe, joins, posts, quality, sampling
from tonegauge.plans import etl, views
from tonegauge.plans.registry import query
from tonegauge.plans.views import (
    COMMENTS, POSTS, TEXT_POSTS, TWO_MODELS, with_views,
)
from tonegauge.schemas import RAW_POSTS, LABELLED_TEXT, schema_drift
from tonegauge.session import checkpoint_folder
from tonegauge.sources import collections, files, sinks


def fresh_folder(spark, name: str) -> str:
    """A folder of its own for each written table, shared by all executors."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Sources and sinks ---------------------------------------------------------------

BY_PLATFORM = """
SELECT platform, count(*) AS n, round(sum(likes_count), 4) AS likes,
  round(avg(engagement_rate), 8) AS mean_rate, count(mentions) AS with_mentions,
  sum(length(text_content))::BIGINT AS chars
FROM posts GROUP BY platform"""


def by_platform(df):
    return df.groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("likes_count"), 4).alias("likes"),
        F.round(F.avg("engagement_rate"), 8).alias("mean_rate"),
        F.count("mentions").alias("with_mentions"),
        F.sum(F.length("text_content")).alias("chars"))


@query("s1_csv_source", with_views(POSTS) + """
SELECT 'raw_csv' AS source_loaded_from, * FROM (""" + BY_PLATFORM + ")")
def s1(spark, sf):
    path = fresh_folder(spark, "s1")
    sinks.write_csv(views.posts(spark, sf), path)
    df = files.read_csv(spark, path, RAW_POSTS, "raw_csv")
    return by_platform(df).withColumn("source_loaded_from", F.lit("raw_csv"))


@query("s2_csv_with_line_breaks", """
SELECT lang AS sentiment_label, count(*) AS n, sum(length(text))::BIGINT AS chars,
  count(distinct text) AS texts
FROM documents GROUP BY lang""")
def s2(spark, sf):
    path = fresh_folder(spark, "s2")
    docs = views.table(spark, sf, "documents")
    sinks.write_csv(docs.select(
        F.col("text").alias("text_content"), F.col("lang").alias("sentiment_label")), path)
    df = files.read_csv(spark, path, LABELLED_TEXT)
    digests = df.select("sentiment_label", F.length("text_content").alias("len"),
                        F.md5("text_content").alias("digest"))
    per_text = digests.groupBy("sentiment_label", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.sum("len").alias("chars"))
    return per_text.groupBy("sentiment_label").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("texts"))


@query("s3_signature_audit", """
SELECT 'image' AS folder, count(*) AS n_png, true AS any_png FROM nation
UNION ALL SELECT 'posts', CAST(0 AS BIGINT), false FROM (SELECT count(*) FROM events)""")
def s3(spark, sf):
    """The posts as CSV next to files, one per nation, that start like an image."""
    path = fresh_folder(spark, "s3")
    sinks.write_csv(views.posts(spark, sf), f"{path}/posts")
    start = F.concat(F.lit(files.PNG_SIGNATURE), F.encode("n_name", "UTF-8")).cast("string")
    views.table(spark, sf, "nation").select(start.alias("value")).write.option(
        "maxRecordsPerFile", 1).text(f"{path}/image")
    audit = files.audit_signatures(spark, path, "part-*")
    return audit.groupBy(F.regexp_extract("path", "/(posts|image)/", 1).alias("folder")).agg(
        F.count_if("is_png").alias("n_png"), F.bool_or("is_png").alias("any_png"))


@query("s4_first_existing_source", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def s4(spark, sf):
    found = files.first_existing(
        spark, [f"{sf}/social_media_final.parquet", f"{sf}/events.parquet"])
    return files.read_parquet(spark, found).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


CAMPAIGN_DIM = """
names AS (
  SELECT campaign_name, row_number() OVER (ORDER BY campaign_name) - 1 AS i
  FROM (SELECT DISTINCT campaign_name FROM posts WHERE campaign_name IS NOT NULL)
), campaigns AS (
  SELECT campaign_name,
    ['awareness', 'conversion', 'retention', 'launch', 'support'][i % 5 + 1] AS campaign_objective,
    ['masivo', 'joven', 'premium', 'tecnico', 'fidelizacion'][i % 5 + 1] AS target_segment,
    CAST(8000 + (i * 1750) % 42000 AS INTEGER) AS planned_budget_usd,
    ['alta', 'media', 'baja'][i % 3 + 1] AS priority_level,
    'simulated_csv_until_api_db_ready' AS external_source_type
  FROM names
)"""


@query("s5_json_source", with_views(POSTS, CAMPAIGN_DIM) + "SELECT * FROM campaigns")
def s5(spark, sf):
    path = fresh_folder(spark, "s5")
    dim = joins.provisional_campaigns(views.posts(spark, sf))
    # One file per campaign, each an array of records.
    dim.select(F.to_json(F.array(F.struct(*dim.columns)))).write.option(
        "maxRecordsPerFile", 1).text(path)
    return files.read_json_array(spark, path)


@query("s7_collection_export", """
SELECT 'mongodb' AS metadata_source, role, count(*) AS n, sum(length(text))::BIGINT AS chars
FROM conversations GROUP BY role""")
def s7(spark, sf):
    path = fresh_folder(spark, "s7")
    rows = views.table(spark, sf, "conversations")
    exported = rows.withColumn("_id", F.concat_ws("-", "conv_id", "turn"))
    sinks.write_report(exported, path)
    df = collections.read_collection(spark, "comments", export=path, schema=exported.schema)
    return df.groupBy("metadata_source", "role").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("s8_toxicity_corpus", with_views(COMMENTS) + """
SELECT comment_id, platform, round(hate_speech_score, 6) AS hate_speech_score FROM comments""")
def s8(spark, sf):
    df = files.toxicity_corpus(views.comments(spark, sf))
    return df.withColumn("hate_speech_score", F.round("hate_speech_score", 6))


NAMED = {code: name for code, name in K.PLATFORM_CODES.items() if name in K.ANALYSED_PLATFORMS}


@query("s9_explain_corpus", with_views(COMMENTS) + """
SELECT platform_name AS platform, round(hate_speech_score, 6) AS score, text FROM named_comments""")
def s9(spark, sf):
    df = files.explain_corpus(views.comments(spark, sf), NAMED)
    return df.withColumn("score", F.round("score", 6))


@query("s11_public_corpus", with_views(COMMENTS) + """
SELECT platform, count(*) AS n FROM comments
WHERE annotator = 0 GROUP BY platform""")
def s11(spark, sf):
    df = files.public_corpus(views.comments(spark, sf), dedup_order="annotator")
    return df.groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


@query("s12_bulk_load", """
SELECT event_type, 2 * count(*) AS n FROM events GROUP BY event_type""")
def s12(spark, sf):
    path = fresh_folder(spark, "s12")
    df = views.table(spark, sf, "events")
    sinks.write_table(df, path, drop=True)
    sinks.write_table(df, path, drop=False)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s13_labelled_benchmark", """
SELECT CASE quality WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' END AS sentiment_label_real,
  count(*) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE quality IN (0, 1) GROUP BY 1""")
def s13(spark, sf):
    df = views.text_posts(spark, sf).select(
        F.col("text_content").alias("text"), F.col("quality").alias("label"))
    real = files.labelled_benchmark(df, K.BENCHMARK_LABELS)
    return real.groupBy("sentiment_label_real").agg(F.count(F.lit(1)).alias("n"))


@query("s14_final_table_sink", with_views(POSTS) + BY_PLATFORM)
def s14(spark, sf):
    path = fresh_folder(spark, "s14")
    sinks.write_table(views.posts(spark, sf), path)
    return by_platform(spark.read.parquet(path))


@query("s15_json_report", with_views(POSTS) + """
SELECT platform, count(mentions) AS with_mentions,
  CASE WHEN false THEN 1e0 END AS not_measured FROM posts GROUP BY platform""")
def s15(spark, sf):
    path = fresh_folder(spark, "s15")
    report = views.posts(spark, sf).groupBy("platform").agg(
        F.count("mentions").alias("with_mentions"),
        F.max(F.lit(None).cast("double")).alias("not_measured"))
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("s16_campaign_dimension", with_views(POSTS, CAMPAIGN_DIM) + "SELECT * FROM campaigns")
def s16(spark, sf):
    return joins.provisional_campaigns(views.posts(spark, sf))


@query("s19_correlation_corpus", with_views(COMMENTS) + """
SELECT platform_name AS platform, platform AS platform_code, count(*) AS n,
  round(sum(sentiment), 4) AS tone, round(sum(hate_speech_score), 4) AS score
FROM named_comments GROUP BY 1, 2""")
def s19(spark, sf):
    df = files.correlation_corpus(
        views.comments(spark, sf), K.PLATFORM_CODES, K.ANALYSED_PLATFORMS)
    return df.groupBy("platform", "platform_code").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("sentiment"), 4).alias("tone"),
        F.round(F.sum("hate_speech_score"), 4).alias("score"))


# Validation, quality and audit ---------------------------------------------------

_DTYPES = {"timestamp": "timestamp_ntz"}


def quality_sql(columns, dtypes, digits: int, source: str) -> str:
    rows = []
    for i, (name, kind) in enumerate(zip(columns, dtypes)):
        leak = "true" if name in K.LEAKAGE_COLUMNS else "false"
        rows.append(f"""
SELECT CAST({i} AS INTEGER) AS position, '{name}' AS "column", '{kind}' AS dtype,
  count(*) - count("{name}") AS missing_values,
  round(100e0 * (count(*) - count("{name}")) / count(*), {digits}) AS missing_pct,
  count(DISTINCT "{name}") AS unique_values, {leak} AS leakage_for_prediction FROM {source}""")
    return "\nUNION ALL".join(rows)


POST_COLUMNS = [f.name for f in RAW_POSTS]
POST_DTYPES = [
    _DTYPES.get(f.name, f.dataType.simpleString()) for f in RAW_POSTS]
TEXT_COLUMNS = ["post_id", "text_content", "language", "brand_name", "hashtags", "mentions",
                "n_chars", "quality", "toxic"]
TEXT_DTYPES = ["bigint", "string", "string", "string", "string", "string", "bigint", "int", "int"]


@query("v2_quality_report", with_views(POSTS) + quality_sql(POST_COLUMNS, POST_DTYPES, 3, "posts"))
def v2(spark, sf):
    return quality.quality_report(views.posts(spark, sf))


@query("v3_basic_quality", with_views(TEXT_POSTS) + "SELECT * EXCLUDE (leakage_for_prediction) FROM ("
       + quality_sql(TEXT_COLUMNS, TEXT_DTYPES, 2, "text_posts") + ")")
def v3(spark, sf):
    return quality.basic_quality(views.text_posts(spark, sf))


@query("v4_column_audit", with_views(POSTS) + 'SELECT "column", missing_values AS nulls, dtype FROM ('
       + quality_sql(POST_COLUMNS, POST_DTYPES, 2, "posts") + ")")
def v4(spark, sf):
    return quality.column_audit(views.posts(spark, sf))


@query("v5_duplicate_rows", """
SELECT sum(n)::BIGINT AS n_rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT AS duplicates
FROM (SELECT text, lang, source, count(*) AS n FROM documents GROUP BY ALL)""")
def v5(spark, sf):
    return quality.duplicate_rows(views.table(spark, sf, "documents").select("text", "lang", "source"))


KEPT = [c for c in POST_COLUMNS if c not in K.DROPPED_COLUMNS]


@query("v8_drop_for_tone", with_views(POSTS) + f"""
SELECT {", ".join(KEPT)}, count(*) AS n FROM posts GROUP BY ALL""")
def v8(spark, sf):
    df = quality.drop_for_tone(views.posts(spark, sf))
    return df.groupBy(df.columns).agg(F.count(F.lit(1)).alias("n"))


@query("v9_label_ranges", with_views(POSTS) + """
SELECT sentiment_label, round(min(sentiment_score), 3) AS min, round(max(sentiment_score), 3) AS max
FROM posts GROUP BY 1""")
def v9(spark, sf):
    return describe.label_ranges(views.posts(spark, sf), "sentiment_label", "sentiment_score")


THRESHOLDS = """
limits AS (
  SELECT quantile_cont(engagement_rate, 0.75) AS p75, quantile_cont(toxicity_score, 0.40) AS p40
  FROM posts WHERE engagement_rate <= 1
), flagged AS (
  SELECT posts.*, CAST(engagement_rate > 1 AS INTEGER) AS fake_engagement_flag,
    likes_count + shares_count + comments_count AS total_interactions,
    CAST(engagement_rate <= 1 AND engagement_rate >= p75 AND sentiment_score > 0
      AND toxicity_score <= p40 AS INTEGER) AS authentic_success_ev3
  FROM posts, limits
)"""



@query("v10_run_summary", with_views(POSTS, THRESHOLDS) + """
SELECT count(*) AS n_rows, CAST(%d AS BIGINT) AS n_columns,
  sum(fake_engagement_flag)::BIGINT AS fake_engagement_posts,
  sum(authentic_success_ev3)::BIGINT AS authentic_success_ev3_posts,
  '%s' AS leakage_columns_flagged
FROM flagged""" % (
    len(RAW_POSTS) + 15,
    ",".join(sorted((set(K.LEAKAGE_COLUMNS) & set(POST_COLUMNS))
                    | {"total_interactions", "log_engagement", "authentic_success_ev3"}))))
def v10(spark, sf):
    return quality.run_summary(etl.transform_posts(views.posts(spark, sf)))


@query("v11_coverage_check", """
SELECT count(*) AS missing_from_enriched FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def v11(spark, sf):
    raw, enriched = views.table(spark, sf, "documents"), views.table(spark, sf, "labels")
    return joins.missing_ids(raw, enriched, "doc_id").agg(
        F.count(F.lit(1)).alias("missing_from_enriched"))


@query("v12_unexpected_codes", """
SELECT label, count(*) AS n FROM embeddings WHERE label NOT IN (0, 1, 2) GROUP BY label""")
def v12(spark, sf):
    return quality.unexpected_codes(views.vectors(spark, sf), "label", list(K.BENCHMARK_LABELS))


@query("v13_input_validation", """
SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM (
  SELECT CASE WHEN text IS NULL THEN 'missing text'
              WHEN length(text) < 1 THEN 'text shorter than 1 character' END AS reason
  FROM (SELECT array_to_string(regexp_extract_all(text, '[#@!][A-Za-z0-9_]*'), '') AS text
        FROM documents))
GROUP BY 1""")
def v13(spark, sf):
    marks = F.concat_ws("", F.regexp_extract_all(
        F.col("text"), F.lit("[#@!][A-Za-z0-9_]*"), F.lit(0)))
    items = views.table(spark, sf, "documents").select(marks.alias("text"))
    valid, rejected = quality.split_valid(items)
    return valid.withColumn("reason", F.lit("valid")).unionByName(rejected).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


# Projections ---------------------------------------------------------------------

@query("p1_parse_timestamp", """
SELECT year(t) AS y, count(*) AS n FROM (
  SELECT try_cast(CASE WHEN user_id % 5 = 0 THEN 'bad ' || user_id
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS t FROM events) GROUP BY 1""".replace(
    "year(t) AS y", "CAST(year(t) AS INTEGER) AS y"))
def p1(spark, sf):
    raw = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit("bad "), "user_id")).otherwise(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
    df = views.table(spark, sf, "events").select(raw.alias("timestamp"))
    parsed = posts.parse_timestamp(df)
    return parsed.groupBy(F.year("timestamp").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("p2_calendar_parts", with_views(POSTS) + """
SELECT CAST(year("timestamp") AS INTEGER) AS "year", CAST(month("timestamp") AS INTEGER) AS "month",
  CAST(hour("timestamp") AS INTEGER) AS "hour", count(*) AS n FROM posts GROUP BY ALL""")
def p2(spark, sf):
    df = posts.add_calendar(views.posts(spark, sf))
    return df.groupBy("year", "month", "hour").agg(F.count(F.lit(1)).alias("n"))


@query("p3_p5_timing_features", with_views(POSTS) + """
SELECT strftime("timestamp", '%A') AS dia_semana, strftime("timestamp", '%B') AS mes,
  CAST(day_of_week IN ('Saturday', 'Sunday') AS INTEGER) AS es_fin_semana,
  CAST(hour("timestamp") BETWEEN 9 AND 18 AS INTEGER) AS es_hora_laboral, count(*) AS n
FROM posts GROUP BY ALL""")
def p3(spark, sf):
    df = posts.add_timing(views.posts(spark, sf))
    return df.groupBy("dia_semana", "mes", "es_fin_semana", "es_hora_laboral").agg(
        F.count(F.lit(1)).alias("n"))


@query("p6_coerce_metrics", """
SELECT post_id, try_cast(raw AS DOUBLE) AS likes_count FROM (
  SELECT event_id AS post_id, CASE WHEN user_id % 7 = 0 THEN event_type
    ELSE CAST(value AS VARCHAR) END AS raw FROM events)""")
def p6(spark, sf):
    raw = F.when(F.col("user_id") % 7 == 0, F.col("event_type")).otherwise(
        F.col("value").cast("string"))
    df = views.table(spark, sf, "events").select(
        F.col("event_id").alias("post_id"), raw.alias("likes_count"))
    return posts.coerce_metrics(df)


@query("p7_p8_interactions_and_rate", with_views(POSTS) + """
SELECT post_id, likes_count + shares_count + comments_count AS total_interactions,
  round(CASE WHEN impressions > 0 THEN (likes_count + shares_count + comments_count) / impressions END, 9)
    AS er_recalc_ev3 FROM posts""")
def p7(spark, sf):
    df = posts.add_recalculated_rate(posts.add_total_interactions(views.posts(spark, sf)))
    return df.select("post_id", "total_interactions",
                     F.round("er_recalc_ev3", 9).alias("er_recalc_ev3"))


@query("p7b_interactions_propagating_nulls", with_views(TEXT_POSTS) + """
SELECT post_id, CAST(quality AS DOUBLE) + CAST(toxic AS DOUBLE) + CAST(n_chars AS DOUBLE)
  AS total_interactions FROM text_posts""")
def p7b(spark, sf):
    df = views.text_posts(spark, sf).select(
        "post_id", F.col("quality").alias("likes_count"), F.col("toxic").alias("shares_count"),
        F.col("n_chars").alias("comments_count"))
    return posts.add_total_interactions(df, null_as_zero=False).select(
        "post_id", "total_interactions")


@query("p9_p10_p11_engagement", with_views(POSTS) + """
SELECT post_id, round(log10(greatest(engagement_rate, 0e0) + 1), 9) AS log_engagement,
  round(ln(1 + engagement_rate), 9) AS log_engagement_ln,
  CAST(engagement_rate > 1 AS INTEGER) AS fake_engagement_flag FROM posts""")
def p9(spark, sf):
    df = posts.add_engagement_flags(views.posts(spark, sf))
    return df.select(
        "post_id", F.round("log_engagement", 9).alias("log_engagement"),
        F.round(posts.natural_log_engagement(F.col("engagement_rate")), 9)
        .alias("log_engagement_ln"), "fake_engagement_flag")


@query("p12_organic_posts", with_views(POSTS) + """
SELECT post_id, engagement_rate FROM posts WHERE NOT coalesce(engagement_rate > 1, false)""")
def p12(spark, sf):
    df = posts.add_engagement_flags(views.posts(spark, sf))
    return posts.organic(df).select("post_id", "engagement_rate")


@query("p13_authentic_success", with_views(POSTS, THRESHOLDS) + """
SELECT post_id, authentic_success_ev3,
  'organic + engagement_p75 + positive_sentiment + toxicity_p40' AS authentic_success_rule
FROM flagged""")
def p13(spark, sf):
    df = posts.flag_authentic_success(posts.add_engagement_flags(views.posts(spark, sf)))
    return df.select("post_id", "authentic_success_ev3", "authentic_success_rule")


ALL_LIMITS = """
limits AS (
  SELECT quantile_cont(engagement_rate, 0.75) AS p75, quantile_cont(toxicity_score, 0.40) AS p40
  FROM posts
), successes AS (
  SELECT posts.*, CAST(engagement_rate >= p75 AND sentiment_score > 0 AND toxicity_score <= p40
    AS INTEGER) AS authentic_success FROM posts, limits
)"""


@query("p14_authentic_success_all_posts", with_views(POSTS, ALL_LIMITS) + """
SELECT post_id, authentic_success FROM successes""")
def p14(spark, sf):
    df = posts.flag_authentic_success(
        views.posts(spark, sf), organic_only=False, out="authentic_success")
    return df.select("post_id", "authentic_success")


@query("p15_provenance_stamp", with_views(POSTS) + """
SELECT platform, true AS utc, count(*) AS n FROM posts GROUP BY platform""")
def p15(spark, sf):
    df = etl.stamp(views.posts(spark, sf))
    return df.groupBy("platform").agg(
        F.bool_and(F.col("etl_processed_at").rlike(r"^\d{4}-\d\d-\d\dT.*\+00:00$")).alias("utc"),
        F.count(F.lit(1)).alias("n"))


@query("p16_p17_coherence", with_views(POSTS) + """
SELECT post_id, CAST((sentiment_label = 'Positive' AND toxicity_score < 0.5)
    OR (sentiment_label = 'Negative' AND toxicity_score > 0.3)
    OR sentiment_label = 'Neutral' AS INTEGER) AS coherencia_sentimiento,
  abs(sentiment_score) AS intensidad_sentimiento FROM posts""")
def p16(spark, sf):
    return posts.add_coherence(views.posts(spark, sf)).select(
        "post_id", "coherencia_sentimiento", "intensidad_sentimiento")


@query("p18_p19_context_counts", with_views(POSTS) + """
SELECT post_id, coalesce(mentions, 'none') AS mentions,
  CAST(mentions IS NOT NULL AND mentions <> 'none' AS INTEGER) AS tiene_mencion,
  CAST(CASE WHEN hashtags IS NULL OR hashtags = '' THEN 0
    ELSE len(string_split(hashtags, ',')) END AS INTEGER) AS n_hashtags FROM posts""")
def p18(spark, sf):
    return posts.add_context_counts(views.posts(spark, sf)).select(
        "post_id", "mentions", "tiene_mencion", "n_hashtags")


TEXT_COUNT_SQL = r"""
SELECT post_id, CAST(length(text_content) AS INTEGER) AS text_len,
  CAST(len(regexp_extract_all(text_content, '[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+')) AS INTEGER) AS word_count,
  CAST(length(hashtags) - length(replace(hashtags, '#', '')) AS INTEGER) AS hashtag_count,
  CAST(coalesce(length(mentions) - length(replace(mentions, '@', '')), 0) AS INTEGER) AS mention_count,
  CAST(contains(text_content, '?') AS INTEGER) AS has_question,
  CAST(contains(text_content, '!') AS INTEGER) AS has_exclamation FROM """


@query("p20_p22_text_counts", with_views(TEXT_POSTS) + TEXT_COUNT_SQL + "text_posts")
def p20(spark, sf):
    return posts.add_text_counts(views.text_posts(spark, sf)).select(
        "post_id", "text_len", "word_count", "hashtag_count", "mention_count",
        "has_question", "has_exclamation")


@query("p22_marks_in_posts", with_views(POSTS) + TEXT_COUNT_SQL + "posts")
def p22(spark, sf):
    return posts.add_text_counts(views.posts(spark, sf)).select(
        "post_id", "text_len", "word_count", "hashtag_count", "mention_count",
        "has_question", "has_exclamation")


@query("p23_manual_text_features", with_views(TEXT_POSTS) + r"""
SELECT post_id, CAST(length(text_content) AS INTEGER) AS len_chars,
  CAST(len(w) AS INTEGER) AS n_words,
  CAST(length(text_content) - length(replace(text_content, '!', '')) AS INTEGER) AS n_exclaim,
  CAST(length(text_content) - length(replace(text_content, '?', '')) AS INTEGER) AS n_question,
  CAST(len(regexp_extract_all(text_content, '\p{Lu}')) AS INTEGER) AS n_upper,
  CASE WHEN len(w) = 0 THEN 0e0 ELSE round(length(array_to_string(w, '')) / len(w), 9) END
    AS avg_word_len
FROM (SELECT *, regexp_extract_all(text_content, '[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+') AS w
      FROM text_posts)""")
def p23(spark, sf):
    df = posts.add_manual_text_features(views.text_posts(spark, sf))
    return df.select("post_id", "len_chars", "n_words", "n_exclaim", "n_question", "n_upper",
                     F.round("avg_word_len", 9).alias("avg_word_len"))


@query("p24_missing_text", with_views(POSTS) + """
SELECT coalesce(mentions, '') AS mentions, count(*) AS filled, count(mentions) AS kept
FROM posts GROUP BY 1""")
def p24(spark, sf):
    df = views.posts(spark, sf)
    filled = posts.fill_text(df, "mentions").groupBy("mentions").agg(
        F.count(F.lit(1)).alias("filled"))
    kept = posts.require_text(df, "mentions").groupBy("mentions").agg(
        F.count(F.lit(1)).alias("kept"))
    return filled.join(kept, "mentions", "left").withColumn(
        "kept", F.coalesce("kept", F.lit(0).cast("bigint")))


@query("p25_toxicity_class", with_views(POSTS) + """
SELECT post_id, CASE WHEN toxicity_score > 0.5 THEN 'alta' ELSE 'baja' END AS clase,
  CAST(toxicity_score > 0.5 AS INTEGER) AS alta FROM posts""")
def p25(spark, sf):
    score = F.col("toxicity_score")
    return views.posts(spark, sf).select(
        "post_id", labels.toxicity_class(score).alias("clase"),
        labels.toxicity_flag(score).alias("alta"))


@query("p26_tone_from_score", with_views(POSTS) + """
SELECT post_id, sentiment_label FROM posts""")
def p26(spark, sf):
    return views.posts(spark, sf).select(
        "post_id", labels.tone_from_score(F.col("sentiment_score")).alias("sentiment_label"))


@query("p27_map_platforms", with_views(COMMENTS) + """
SELECT platform_name, count(*) AS n, round(sum(hate_speech_score), 4) AS score
FROM named_comments GROUP BY 1""")
def p27(spark, sf):
    df = posts.clean_scores(posts.map_platforms(views.comments(spark, sf)))
    return df.groupBy("platform_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("hate_speech_score"), 4).alias("score"))


@query("p27b_map_platforms_from_text", """
SELECT lower(event_type) AS platform_name, count(*) AS n FROM events
WHERE event_type IN ('click', 'view') GROUP BY 1""")
def p27b(spark, sf):
    shouted = views.table(spark, sf, "events").select(
        F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")).alias("platform"))
    df = posts.map_platforms(shouted, keep=["click", "view"])
    return df.groupBy("platform_name").agg(F.count(F.lit(1)).alias("n"))


@query("p28_normalise_tweet", r"""
SELECT doc_id, regexp_replace(regexp_replace(text, '@[\p{L}\p{N}_]+', '@user', 'g'),
  'https?://[^\s\x{0b}]+', 'http', 'g') AS text FROM documents""")
def p28(spark, sf):
    return views.table(spark, sf, "documents").select(
        "doc_id", text.normalise_tweet(F.col("text")).alias("text"))


@query("p29_canonical_label", """
SELECT event_id, CASE k WHEN 0 THEN 'Negative' WHEN 1 THEN 'Positive' WHEN 2 THEN 'Neutral'
  ELSE upper(substr(event_type, 1, 1)) || substr(event_type, 2) END AS label
FROM (SELECT event_id, event_type, user_id % 4 AS k FROM events)""")
def p29(spark, sf):
    k = F.col("user_id") % 4
    raw = F.when(k == 0, " NEGATIVE").when(k == 1, "LABEL_2").when(k == 2, "neutral ").otherwise(
        F.upper("event_type"))
    return views.table(spark, sf, "events").select(
        "event_id", labels.canonical_label(raw).alias("label"))


@query("p31_terms", with_views(COMMENTS) + """
SELECT comment_id, annotator, list_filter(regexp_extract_all(lower(text), '[a-záéíóúñü]+'),
  lambda t: length(t) > 2 AND t NOT IN (%s)) AS terms FROM comments""" % sql_list(K.TERM_STOPWORDS))
def p31(spark, sf):
    return views.comments(spark, sf).select(
        "comment_id", "annotator", text.terms(F.col("text")).alias("terms"))


@query("p33_topic_names", with_views(POSTS) + """
SELECT topic_category, CASE topic_category %s END AS tema_nombre, count(*) AS n
FROM posts GROUP BY ALL""" % " ".join(
    f"WHEN 'Topic{i}' THEN '{name}'" for i, name in K.TOPIC_NAMES.items()))
def p33(spark, sf):
    cluster = F.substring("topic_category", 6, 2).cast("int")
    df = views.posts(spark, sf).select(
        "topic_category", labels.lookup(cluster, K.TOPIC_NAMES).alias("tema_nombre"))
    return df.groupBy("topic_category", "tema_nombre").agg(F.count(F.lit(1)).alias("n"))


@query("p34_operational_extract", with_views(POSTS) + """
SELECT post_id, platform, brand_name, campaign_phase, sentiment_label, engagement_rate, toxicity_score
FROM posts ORDER BY post_id LIMIT 200""")
def p34(spark, sf):
    return posts.operational_extract(views.posts(spark, sf), "post_id")


# Joins, unions and de-duplication -------------------------------------------------

@query("j1_attach_campaigns", with_views(POSTS, CAMPAIGN_DIM) + """
SELECT priority_level, campaign_objective, target_segment, count(*) AS n,
  sum(planned_budget_usd)::BIGINT AS budget, round(avg(engagement_rate), 6) AS mean_engagement
FROM posts LEFT JOIN campaigns USING (campaign_name) GROUP BY 1, 2, 3""")
def j1(spark, sf):
    df = views.posts(spark, sf)
    joined = joins.attach_campaigns(df, joins.provisional_campaigns(df))
    return joined.groupBy("priority_level", "campaign_objective", "target_segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("planned_budget_usd").alias("budget"),
        F.round(F.avg("engagement_rate"), 6).alias("mean_engagement"))


@query("j2_existence_flag", """
SELECT d.doc_id AS post_id, d.doc_id IN (SELECT doc_id FROM labels) AS exists_in_raw_source
FROM documents d""")
def j2(spark, sf):
    docs = views.table(spark, sf, "documents").select(F.col("doc_id").alias("post_id"))
    marked = joins.existence_flag(docs, views.table(spark, sf, "labels"), "post_id", other_key="doc_id")
    return marked.select("post_id", "exists_in_raw_source")


@query("j3_missing_ids", """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def j3(spark, sf):
    return joins.missing_ids(
        views.table(spark, sf, "documents"), views.table(spark, sf, "labels"), "doc_id")


@query("j4_keep_platforms", """
SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')""")
def j4(spark, sf):
    df = views.table(spark, sf, "events").select("event_id", "event_type", "value")
    return joins.keep_platforms(df, "event_type", ["click", "view"])


@query("j5_code_lookup", with_views(COMMENTS) + """
SELECT platform, CASE platform WHEN 0 THEN 'reddit' WHEN 1 THEN 'reference' WHEN 2 THEN 'twitter'
  WHEN 3 THEN 'youtube' END AS platform_name, count(*) AS n FROM comments GROUP BY ALL""")
def j5(spark, sf):
    df = views.comments(spark, sf).select(
        "platform", labels.lookup(F.col("platform"), K.PLATFORM_CODES).alias("platform_name"))
    return df.groupBy("platform", "platform_name").agg(F.count(F.lit(1)).alias("n"))


@query("j6_align_models", with_views(TWO_MODELS) + """
SELECT item_id, model_a, model_b FROM two_models""")
def j6(spark, sf):
    both = views.two_models(spark, sf)
    return joins.align_models(
        both.select("item_id", "model_a"), both.select("item_id", "model_b"), "item_id")


@query("u1_union_metadata", with_views(POSTS, CAMPAIGN_DIM) + """
SELECT campaign_name, campaign_objective, planned_budget_usd, priority_level,
  'external_csv' AS metadata_source, CAST(0 AS INTEGER) AS source_priority FROM campaigns
UNION ALL
SELECT campaign_name, 'relaunch', NULL, NULL, 'api_json', 1 FROM campaigns
WHERE campaign_name IN ('C3', 'C5')""")
def u1(spark, sf):
    return joins.union_sources(campaign_sources(spark, sf))


def campaign_sources(spark, sf):
    dim = joins.provisional_campaigns(views.posts(spark, sf))
    base = dim.select("campaign_name", "campaign_objective", "planned_budget_usd", "priority_level")
    override = dim.where(F.col("campaign_name").isin("C3", "C5")).select(
        "campaign_name", F.lit("relaunch").alias("campaign_objective"))
    return [("external_csv", base), ("api_json", override)]


@query("d1_dedup_comments", with_views(COMMENTS) + """
SELECT comment_id, platform, round(hate_speech_score, 6) AS hate_speech_score FROM (
  SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY annotator) AS r FROM comments)
WHERE r = 1""")
def d1(spark, sf):
    df = joins.dedup_comments(views.comments(spark, sf), "annotator")
    return df.select("comment_id", "platform", F.round("hate_speech_score", 6).alias("hate_speech_score"))


@query("d2_latest_metadata", with_views(POSTS, CAMPAIGN_DIM) + """
SELECT campaign_name,
  CASE WHEN campaign_name IN ('C3', 'C5') THEN 'relaunch' ELSE campaign_objective END
    AS campaign_objective,
  CASE WHEN campaign_name NOT IN ('C3', 'C5') THEN planned_budget_usd END AS planned_budget_usd,
  CASE WHEN campaign_name NOT IN ('C3', 'C5') THEN priority_level END AS priority_level,
  CASE WHEN campaign_name IN ('C3', 'C5') THEN 'api_json' ELSE 'external_csv' END
    AS metadata_source
FROM campaigns""")
def d2(spark, sf):
    return joins.latest_metadata(joins.union_sources(campaign_sources(spark, sf)))


@query("w6_dense_index", """
SELECT text AS name, row_number() OVER (ORDER BY text) - 1 AS position
FROM (SELECT DISTINCT md5(text) AS text FROM documents)""")
def w6(spark, sf):
    names = views.table(spark, sf, "documents").select(F.md5("text").alias("name"))
    return joins.dense_index(names, "name")


# The whole posts job ---------------------------------------------------------------

ENRICHED = POSTS.replace("), posts AS (", "), all_posts AS (", 1).rstrip() + """, posts AS (
  SELECT * FROM all_posts WHERE CAST(post_id AS BIGINT) % 10 <> 0
)"""


@query("etl_platform_report", with_views(ENRICHED, THRESHOLDS) + """
SELECT platform, count(*) AS posts, count(*) FILTER (CAST(post_id AS BIGINT) % 7 <> 0) AS in_raw,
  sum(fake_engagement_flag)::BIGINT AS fake, sum(authentic_success_ev3)::BIGINT AS authentic,
  round(avg(engagement_rate), 6) AS mean_engagement, round(sum(total_interactions), 2) AS interactions,
  round(avg(CAST(fake_engagement_flag AS DOUBLE)) * 100, 4) AS fake_pct,
  sum(planned_budget_usd)::BIGINT AS budget
FROM flagged LEFT JOIN (
  SELECT campaign_name, CAST(8000 + (i * 1750) % 42000 AS INTEGER) AS planned_budget_usd FROM (
    SELECT campaign_name, row_number() OVER (ORDER BY campaign_name) - 1 AS i
    FROM (SELECT DISTINCT campaign_name FROM posts))) campaigns USING (campaign_name) GROUP BY platform""")
def etl_platform_report(spark, sf):
    """Enriched posts lack every tenth post, the raw source every seventh."""
    base, key = views.posts(spark, sf), F.col("post_id").cast("bigint")
    raw, enriched = base.where(key % 7 != 0), base.where(key % 10 != 0)
    final = etl.integrate(raw, enriched, joins.provisional_campaigns(enriched))
    return final.groupBy("platform").agg(
        F.count(F.lit(1)).alias("posts"), F.count_if("exists_in_raw_source").alias("in_raw"),
        F.sum("fake_engagement_flag").alias("fake"),
        F.sum("authentic_success_ev3").alias("authentic"),
        F.round(F.avg("engagement_rate"), 6).alias("mean_engagement"),
        F.round(F.sum("total_interactions"), 2).alias("interactions"),
        F.round(F.avg("fake_engagement_flag") * 100, 4).alias("fake_pct"),
        F.sum("planned_budget_usd").alias("budget"))
