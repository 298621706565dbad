"""Registered queries: descriptive statistics, ranks and tests, terms, timing, samples."""

from pyspark.sql import functions as F

from tonegauge import constants as K
from tonegauge.operators import (
    correlation, describe, metrics, ordering, posts, ranktests, sampling, terms, timing,
)
from tonegauge.plans import views
from tonegauge.plans.queries_posts import ALL_LIMITS, fresh_folder, sql_list
from tonegauge.plans.registry import query
from tonegauge.plans.views import (
    COMMENTS, PLATFORMS, POSTS, SCORED, TEXT_POSTS, with_views,
)
from tonegauge.schemas import columns
from tonegauge.sources import files, sinks


def organic_posts(spark, sf):
    df = posts.add_engagement_flags(posts.add_timing(views.posts(spark, sf)))
    return posts.add_coherence(df)


ORGANIC = """
timed AS (
  SELECT *, CAST(hour("timestamp") AS INTEGER) AS hora, strftime("timestamp", '%A') AS dia_semana,
    CAST(engagement_rate > 1 AS INTEGER) AS fake_engagement_flag,
    CAST((sentiment_label = 'Positive' AND toxicity_score < 0.5)
      OR (sentiment_label = 'Negative' AND toxicity_score > 0.3)
      OR sentiment_label = 'Neutral' AS INTEGER) AS coherencia_sentimiento
  FROM posts
), organic AS (SELECT * FROM timed WHERE fake_engagement_flag = 0)"""


# Aggregations ----------------------------------------------------------------------

@query("a1_score_summary", with_views(SCORED) + """
SELECT platform, count(*) AS n, round(avg(score), 4) AS mean, round(quantile_cont(score, 0.5), 4) AS median,
  round(stddev_samp(score), 4) AS std, round(min(score), 4) AS min, round(max(score), 4) AS max
FROM scored GROUP BY platform""")
def a1(spark, sf):
    return describe.score_summary(views.scored(spark, sf), "platform", "score")


DISTRIBUTION = """
SELECT platform, count(*) AS n, round(avg(score), 4) AS mean, round(quantile_cont(score, 0.5), 4) AS median,
  round(stddev_samp(score), 4) AS std, round(quantile_cont(score, 0.25), 4) AS q25,
  round(quantile_cont(score, 0.75), 4) AS q75, round(quantile_cont(score, 0.95), 4) AS q95,
  round(max(score), 4) AS max, round(avg(score) FILTER (score <= 60), 4) AS mean_sin_cola
FROM scored GROUP BY platform"""


@query("a2_score_distribution", with_views(SCORED) + DISTRIBUTION)
def a2(spark, sf):
    return describe.score_distribution(views.scored(spark, sf), "platform", "score", 60.0)


@query("a2b_comment_distribution", with_views(COMMENTS) + """
SELECT platform_name, count(*) AS n, round(avg(s), 4) AS mean, round(quantile_cont(s, 0.5), 4) AS median,
  round(stddev_samp(s), 4) AS std, round(quantile_cont(s, 0.25), 4) AS q25,
  round(quantile_cont(s, 0.75), 4) AS q75, round(quantile_cont(s, 0.95), 4) AS q95,
  round(max(s), 4) AS max, round(avg(s) FILTER (s <= 0.5), 4) AS mean_sin_cola
FROM (SELECT *, hate_speech_score AS s FROM named_comments) GROUP BY platform_name""")
def a2b(spark, sf):
    df = posts.map_platforms(views.comments(spark, sf))
    return describe.score_distribution(df, "platform_name", "hate_speech_score")


@query("a3_threshold_share", with_views(SCORED) + """
SELECT platform, count(*) AS n, count(*) FILTER (score > 60) AS n_toxicos,
  round(100e0 * count(*) FILTER (score > 60) / count(*), 2) AS pct_toxicos
FROM scored GROUP BY platform""")
def a3(spark, sf):
    return describe.threshold_share(views.scored(spark, sf), "platform", "score", 60.0)


RANKING = """
ranking AS (SELECT platform, round(avg(score), 4) AS score_medio FROM scored GROUP BY platform)"""


@query("a4_ranking_reading", with_views(SCORED, RANKING) + """
SELECT arg_max(platform, score_medio) AS most_toxic_platform,
  arg_min(platform, score_medio) AS least_toxic_platform,
  bool_and(score_medio < 0) AS all_means_negative,
  arg_max(platform, score_medio) = 'click' AS hypothesis_confirmed FROM ranking""")
def a4(spark, sf):
    ranking = describe.mean_ranking(views.scored(spark, sf), "platform", "score")
    return describe.ranking_reading(ranking, "platform", "click")


@query("p32_relative_index", with_views(SCORED, RANKING) + """
SELECT platform, score_medio,
  round(score_medio - (SELECT min(score_medio) FROM ranking), 4) AS toxicidad_relativa,
  printf('%s (%.3f)', platform, score_medio) AS lectura FROM ranking""")
def p32(spark, sf):
    ranking = describe.mean_ranking(views.scored(spark, sf), "platform", "score")
    return describe.relative_index(ranking, "platform")


@query("a5_w5_value_counts", with_views(POSTS) + """
SELECT sentiment_label, count(*) AS n, round(100e0 * count(*) / sum(count(*)) OVER (), 2) AS pct
FROM posts GROUP BY sentiment_label""")
def a5(spark, sf):
    return describe.value_counts(views.posts(spark, sf), "sentiment_label")


@query("a6_fake_volume", with_views(POSTS, ORGANIC) + """
SELECT count(*) AS posts, sum(fake_engagement_flag)::BIGINT AS fake,
  (count(*) - sum(fake_engagement_flag))::BIGINT AS organic,
  round(100e0 * sum(fake_engagement_flag) / count(*), 1) AS fake_pct,
  round(100e0 * (count(*) - sum(fake_engagement_flag)) / count(*), 1) AS organic_pct FROM timed""")
def a6(spark, sf):
    return describe.fake_volume(posts.add_engagement_flags(views.posts(spark, sf)))


@query("a7_fake_share_by_platform", with_views(POSTS, ORGANIC) + """
SELECT platform, round(avg(fake_engagement_flag) * 100, 4) AS fake_pct FROM timed GROUP BY platform""")
def a7(spark, sf):
    df = posts.add_engagement_flags(views.posts(spark, sf))
    return describe.share_by(df, "platform", "fake_engagement_flag", "fake_pct").orderBy(
        F.col("fake_pct").desc(), "platform")


@query("a8_mean_engagement", with_views(POSTS) + """
SELECT platform, round(avg(engagement_rate), 6) AS engagement_rate FROM posts GROUP BY platform""")
def a8(spark, sf):
    return describe.mean_by(views.posts(spark, sf), "platform", ["engagement_rate"], 6)


@query("a9_executive_kpis", with_views(POSTS, ALL_LIMITS) + """
SELECT count(*) AS posts, count(DISTINCT platform) AS platforms,
  count(DISTINCT campaign_name) AS campaigns, round(avg(authentic_success) * 100, 1) AS authentic_pct,
  round(avg(engagement_rate), 3) AS mean_engagement FROM successes""")
def a9(spark, sf):
    df = posts.flag_authentic_success(
        views.posts(spark, sf), organic_only=False, out="authentic_success")
    return describe.executive_kpis(df)


@query("a10_coherence_by_label", with_views(POSTS, ORGANIC) + """
SELECT sentiment_label, round(avg(coherencia_sentimiento) * 100, 4) AS coherent_pct
FROM organic GROUP BY sentiment_label""")
def a10(spark, sf):
    df = posts.organic(organic_posts(spark, sf))
    return describe.share_by(df, "sentiment_label", "coherencia_sentimiento", "coherent_pct")


HOURS = """
hours AS (
  SELECT hora, avg(impressions) AS imp_media, avg(engagement_rate) AS eng_media,
    count(impressions) AS n_posts
  FROM organic GROUP BY hora
)"""


def hours(spark, sf):
    return timing.hour_profile(posts.organic(organic_posts(spark, sf)))


def rounded(df, names=("imp_media", "eng_media"), digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query("a11_hour_profile", with_views(POSTS, ORGANIC, HOURS) + """
SELECT hora, round(imp_media, 6) AS imp_media, round(eng_media, 6) AS eng_media, n_posts FROM hours""")
def a11(spark, sf):
    return rounded(hours(spark, sf))


@query("a12_day_profile", with_views(POSTS, ORGANIC) + """
SELECT CAST(d.position AS INTEGER) AS position, d.dia_semana, round(avg(impressions), 2) AS imp_media,
  round(avg(engagement_rate), 6) AS eng_media
FROM (SELECT unnest([%s]) AS dia_semana, generate_subscripts([%s], 1) - 1 AS position) d
LEFT JOIN organic o ON d.dia_semana = o.dia_semana GROUP BY 1, 2""" % (
    sql_list(K.WEEKDAYS), sql_list(K.WEEKDAYS)))
def a12(spark, sf):
    df = timing.day_profile(posts.organic(organic_posts(spark, sf)))
    return df.select("position", "dia_semana", F.round("imp_media", 2).alias("imp_media"),
                     F.round("eng_media", 6).alias("eng_media"))


@query("a13_day_hour_profile", with_views(POSTS, ORGANIC) + """
SELECT dia_semana, hora, round(avg(impressions), 6) AS impressions FROM organic GROUP BY 1, 2""")
def a13(spark, sf):
    df = timing.day_hour_profile(posts.organic(organic_posts(spark, sf)))
    return df.withColumn("impressions", F.round("impressions", 6))


@query("o2_top_hours", with_views(POSTS, ORGANIC, HOURS) + """
(SELECT 'impressions' AS by, hora, round(imp_media, 6) AS value FROM hours
 ORDER BY imp_media DESC, hora LIMIT 5)
UNION ALL
(SELECT 'engagement', hora, round(eng_media, 6) FROM hours ORDER BY eng_media DESC, hora LIMIT 5)""")
def o2(spark, sf):
    profile = hours(spark, sf)
    tops = [
        timing.top_rows(profile, c, ["hora"]).select(
            F.lit(name).alias("by"), "hora", F.round(c, 6).alias("value"))
        for name, c in (("impressions", "imp_media"), ("engagement", "eng_media"))
    ]
    return tops[0].unionByName(tops[1])


@query("o2b_top_day_hours", with_views(POSTS, ORGANIC) + """
SELECT dia_semana, hora, round(avg(impressions), 6) AS impressions FROM organic GROUP BY 1, 2
ORDER BY avg(impressions) DESC, dia_semana, hora LIMIT 5""")
def o2b(spark, sf):
    df = timing.day_hour_profile(posts.organic(organic_posts(spark, sf)))
    return rounded(timing.top_rows(df, "impressions", ["dia_semana", "hora"]), ["impressions"])


@query("o3_best_hours", with_views(POSTS, ORGANIC, HOURS) + """
SELECT (SELECT hora FROM hours ORDER BY imp_media DESC, hora LIMIT 1) AS hora_max_imp,
  (SELECT round(max(imp_media), 6) FROM hours) AS imp_max,
  (SELECT hora FROM hours ORDER BY eng_media DESC, hora LIMIT 1) AS hora_max_eng,
  (SELECT round(max(eng_media), 6) FROM hours) AS eng_max""")
def o3(spark, sf):
    return rounded(timing.best_hours(hours(spark, sf)), ["imp_max", "eng_max"])


@query("o4_hour_zones", with_views(POSTS, ORGANIC, HOURS) + """
SELECT hora, n_posts, CASE WHEN i AND e THEN 'sweet_spot' WHEN i THEN 'alto_alcance'
  WHEN e THEN 'alto_engagement' ELSE 'bajo' END AS zona
FROM (SELECT hora, n_posts, imp_media > avg(imp_media) OVER () AS i,
        eng_media > avg(eng_media) OVER () AS e FROM hours)""")
def o4(spark, sf):
    return timing.hour_zones(hours(spark, sf)).select("hora", "n_posts", "zona")


@query("o8_category_order", with_views(POSTS) + """
SELECT CAST(coalesce(nullif(list_position(['Positive', 'Neutral'], sentiment_label), 0), 3) AS BIGINT)
  AS position, sentiment_label, count(*) AS n FROM posts GROUP BY 1, 2""")
def o8(spark, sf):
    counts = views.posts(spark, sf).groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    return describe.ordered_categories(counts, "sentiment_label", ["Positive", "Neutral"])


@query("a14_term_counts", with_views(COMMENTS) + """
SELECT platform_name, term, count(*) AS n FROM (
  SELECT platform_name, unnest(list_filter(regexp_extract_all(lower(text), '[a-záéíóúñü]+'),
    lambda t: length(t) > 2 AND t NOT IN (%s))) AS term
  FROM named_comments WHERE hate_speech_score > 0.5) GROUP BY 1, 2""" % sql_list(K.TERM_STOPWORDS))
def a14(spark, sf):
    df = posts.map_platforms(views.comments(spark, sf)).where("hate_speech_score > 0.5")
    return terms.term_counts(df, "platform_name")


@query("u2_vocabulary_union", with_views(COMMENTS) + """
SELECT term, count(*) AS n FROM (
  SELECT unnest(list_filter(regexp_extract_all(lower(text), '[a-záéíóúñü]+'),
    lambda t: length(t) > 2 AND t NOT IN (%s))) AS term
  FROM named_comments) GROUP BY 1""" % sql_list(K.TERM_STOPWORDS))
def u2(spark, sf):
    return terms.vocabulary(terms.term_counts(
        posts.map_platforms(views.comments(spark, sf)), "platform_name"))


def distinctive_sql(source: str, group: str, groups: list[str], threshold: float) -> str:
    return """, tokens AS (
  SELECT g, term, count(*) AS y FROM (
    SELECT {group} AS g, unnest(list_filter(regexp_extract_all(lower(text), '[a-záéíóúñü]+'),
      lambda t: length(t) > 2 AND t NOT IN ({stop}))) AS term
    FROM {source} WHERE score > {threshold} AND {group} IN ({groups})) GROUP BY 1, 2
), sized AS (
  SELECT g, term, CAST(y AS DOUBLE) AS y, CAST(sum(y) OVER (PARTITION BY term) AS DOUBLE) AS a,
    CAST(sum(y) OVER (PARTITION BY g) AS DOUBLE) AS n, CAST(sum(y) OVER () AS DOUBLE) AS t
  FROM tokens
), scored_terms AS (
  SELECT g AS {group}, term, CAST(y AS BIGINT) AS n,
    round((ln((y + a) / (n + t - y - a)) - ln((a - y + a) / (t - n + t - (a - y + a))))
      / sqrt(1 / (y + a) + 1 / (a - y + a)), 3) AS z
  FROM sized WHERE y >= 5 AND n + t - y - a > 0 AND t - n + t - (a - y + a) > 0
)
SELECT {group}, term, z, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY z DESC, n DESC, term) AS rank
  FROM scored_terms WHERE z > 0) WHERE rank <= 15""".format(
        source=source, group=group, threshold=threshold, groups=sql_list(groups),
        stop=sql_list(K.TERM_STOPWORDS))


@query("a15_distinctive_terms", with_views(COMMENTS, """
named AS (SELECT platform_name, hate_speech_score AS score, text FROM named_comments)""")
       + distinctive_sql("named", "platform_name", K.ANALYSED_PLATFORMS, 0.5))
def a15(spark, sf):
    df = posts.map_platforms(views.comments(spark, sf)).withColumnRenamed("hate_speech_score", "score")
    return terms.distinctive_terms(df, "platform_name", K.ANALYSED_PLATFORMS)


LANGUAGES = ["de", "en", "es", "fr"]


@query("a15b_distinctive_terms_of_languages", """
WITH texts AS (SELECT lang AS language, text, CAST(n_chars AS DOUBLE) AS score FROM documents)
""" + distinctive_sql("texts", "language", LANGUAGES, 0))
def a15b(spark, sf):
    df = views.table(spark, sf, "documents").select(
        F.col("lang").alias("language"), "text", F.col("n_chars").cast("double").alias("score"))
    return terms.distinctive_terms(df, "language", LANGUAGES, threshold=0.0)


@query("a15c_no_toxic_notice", with_views(SCORED) + """
SELECT count(*) FILTER (score > 1000000) AS n_toxicos,
  CASE WHEN count(*) FILTER (score > 1000000) = 0 THEN 'no comment exceeds the threshold' END AS aviso
FROM scored""")
def a15c(spark, sf):
    return terms.toxic_notice(views.scored(spark, sf), threshold=1e6)


@query("a16_j7_keyword_effect", with_views(POSTS) + """
SELECT palabra, count(*) FILTER (hit) AS n_posts,
  round(avg(toxicity_score) FILTER (hit), 3) AS tox_medio_con,
  round(avg(toxicity_score) FILTER (NOT hit), 3) AS tox_medio_sin,
  round(round(avg(toxicity_score) FILTER (hit), 3) - round(avg(toxicity_score) FILTER (NOT hit), 3), 3)
    AS diferencia
FROM (SELECT palabra, toxicity_score, contains(lower(text_content), palabra) AS hit
      FROM posts, (SELECT unnest([%s]) AS palabra))
GROUP BY palabra HAVING count(*) FILTER (hit) > 30""" % sql_list(
    K.TOXICITY_KEYWORDS + ["click", "rated 1", "user 12"]))
def a16(spark, sf):
    return terms.keyword_effect(
        views.posts(spark, sf), keywords=K.TOXICITY_KEYWORDS + ["click", "rated 1", "user 12"])


@query("a16b_keywords_in_documents", with_views(TEXT_POSTS) + """
SELECT palabra, count(*) FILTER (hit) AS n_posts, round(avg(n_chars) FILTER (hit), 3) AS tox_medio_con,
  round(avg(n_chars) FILTER (NOT hit), 3) AS tox_medio_sin,
  round(round(avg(n_chars) FILTER (hit), 3) - round(avg(n_chars) FILTER (NOT hit), 3), 3) AS diferencia
FROM (SELECT palabra, n_chars, contains(lower(text_content), palabra) AS hit
      FROM text_posts, (SELECT unnest(['with', 'que', 'und', 'hate', 'the']) AS palabra))
GROUP BY palabra HAVING count(*) FILTER (hit) > 30""")
def a16b(spark, sf):
    return terms.keyword_effect(
        views.text_posts(spark, sf), score="n_chars", keywords=["with", "que", "und", "hate", "the"])


CROSS = ", ".join(
    f"count(*) FILTER (sentiment_label = '{v}') AS \"{v}\"" for v in K.TONE_LABELS)


@query("a17_crosstab", with_views(POSTS) + f"SELECT topic_category, {CROSS} FROM posts GROUP BY 1")
def a17(spark, sf):
    return describe.crosstab(
        views.posts(spark, sf), "topic_category", "sentiment_label", K.TONE_LABELS)


@query("a17b_crosstab_shares", with_views(POSTS) + "SELECT topic_category, " + ", ".join(
    f"round(count(*) FILTER (sentiment_label = '{v}') / CAST(count(*) AS DOUBLE), 2) AS \"{v}\""
    for v in K.TONE_LABELS) + " FROM posts GROUP BY 1")
def a17b(spark, sf):
    return describe.crosstab(
        views.posts(spark, sf), "topic_category", "sentiment_label", K.TONE_LABELS, normalise=True)


@query("a18_cluster_profile", with_views(POSTS, ORGANIC) + """
SELECT topic_category, round(avg(coherencia_sentimiento), 4) AS coherencia_sentimiento,
  round(avg(toxicity_score), 4) AS toxicity_score, round(avg(sentiment_score), 4) AS sentiment_score,
  round(avg(engagement_rate), 4) AS engagement_rate,
  CASE WHEN round(avg(coherencia_sentimiento), 4) > 0.7 THEN 'Coherente' ELSE 'Incoherente' END AS tipo
FROM organic GROUP BY topic_category""")
def a18(spark, sf):
    df = posts.organic(organic_posts(spark, sf))
    measures = ["coherencia_sentimiento", "toxicity_score", "sentiment_score", "engagement_rate"]
    return describe.name_clusters(describe.mean_by(df, "topic_category", measures))


@query("a21_tail_reading", with_views(SCORED) + """
SELECT round(max(median) - min(median), 4) AS median_range, round(max(q95) - min(q95), 4) AS q95_range,
  max(q95) - min(q95) > max(median) - min(median) AS tail_not_average FROM (""" + DISTRIBUTION + ")")
def a21(spark, sf):
    return describe.tail_reading(
        describe.score_distribution(views.scored(spark, sf), "platform", "score", 60.0))


@query("a37_melt_metrics", with_views(SCORED) + """
SELECT platform, metrica, valor FROM (
  UNPIVOT (SELECT platform, CAST(count(*) AS DOUBLE) AS n, round(avg(score), 6) AS mean,
             max(score) AS max FROM scored GROUP BY platform)
  ON n, mean, max INTO NAME metrica VALUE valor)""")
def a37(spark, sf):
    wide = views.scored(spark, sf).groupBy("platform").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.round(F.avg("score"), 6).alias("mean"),
        F.max("score").alias("max"))
    return describe.melt(wide, ["platform"], ["n", "mean", "max"], "metrica", "valor")


@query("a38_box_stats", with_views(SCORED) + """
SELECT s.platform, any_value(round(q1, 4)) AS q1, any_value(round(median, 4)) AS median,
  any_value(round(q3, 4)) AS q3,
  round(min(score) FILTER (score >= q1 - 1.5 * (q3 - q1)), 4) AS whisker_low,
  round(max(score) FILTER (score <= q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
  count(*) FILTER (score < q1 - 1.5 * (q3 - q1) OR score > q3 + 1.5 * (q3 - q1)) AS outliers
FROM scored s JOIN (
  SELECT platform, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median,
    quantile_cont(score, 0.75) AS q3 FROM scored GROUP BY platform) q ON s.platform = q.platform
GROUP BY s.platform""")
def a38(spark, sf):
    return describe.box_stats(views.scored(spark, sf), "platform", "score")


# Ranks, tests and correlation --------------------------------------------------------

RANKS = """
ranked AS (
  SELECT platform, score,
    rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS r
  FROM scored
)"""


@query("w2_average_ranks", with_views(SCORED, RANKS) + """
SELECT score AS value, count(*) AS n, any_value(r) AS avg_rank FROM ranked GROUP BY score""")
def w2(spark, sf):
    return ordering.value_ladder(views.scored(spark, sf), "score", "platform", PLATFORMS).select(
        "value", "n", "avg_rank")


@query("w2b_rank_sums", with_views(SCORED, RANKS) + """
SELECT platform, round(sum(r), 1) AS rank_sum FROM ranked GROUP BY platform""")
def w2b(spark, sf):
    ladder = ordering.value_ladder(views.scored(spark, sf), "score", "platform", PLATFORMS)
    sums = ladder.agg(*[
        F.round(F.sum(F.col(f"n_{i}") * F.col("avg_rank")), 1).alias(p)
        for i, p in enumerate(PLATFORMS)])
    return sums.unpivot([], PLATFORMS, "platform", "rank_sum")


# With four degrees of freedom the chi-square tail is exp(-x/2) (1 + x/2).
@query("a22_kruskal_wallis", with_views(SCORED, RANKS) + """
SELECT CAST(5 AS INTEGER) AS groups, n, round(h, 4) AS h_statistic,
  round(exp(-h / 2) * (1 + h / 2), 8) AS p_value,
  exp(-h / 2) * (1 + h / 2) < 0.05 AS significant_0_05
FROM (
  SELECT CAST(sum(k) AS BIGINT) AS n,
    (12 / (sum(k) * (sum(k) + 1)) * sum(s * s / k) - 3 * (sum(k) + 1))
      / (1 - (SELECT sum(c * c * c - c) FROM (
          SELECT CAST(count(*) AS DOUBLE) AS c FROM scored GROUP BY score)) / (sum(k) ** 3 - sum(k))) AS h
  FROM (SELECT platform, CAST(count(*) AS DOUBLE) AS k, sum(r) AS s FROM ranked GROUP BY platform))""")
def a22(spark, sf):
    df = ranktests.kruskal_wallis(views.scored(spark, sf), "score", "platform", PLATFORMS)
    return df.withColumns({"h_statistic": F.round("h_statistic", 4), "p_value": F.round("p_value", 8)})


# Two-sided normal p as a power series around 0, exact enough for the z of these pairs.
PAIRS = """
pairs AS (
  SELECT x.platform AS group_a, y.platform AS group_b FROM
  (SELECT DISTINCT platform FROM scored) x, (SELECT DISTINCT platform FROM scored) y
  WHERE x.platform < y.platform
), cells AS (SELECT platform, score, CAST(count(*) AS DOUBLE) AS c FROM scored GROUP BY 1, 2
), pooled AS (
  SELECT group_a, group_b, score,
    coalesce(sum(c) FILTER (platform = group_a), 0) AS ca,
    coalesce(sum(c) FILTER (platform = group_b), 0) AS cb
  FROM pairs JOIN cells ON platform IN (group_a, group_b) GROUP BY 1, 2, 3
), running AS (
  SELECT *, sum(cb) OVER (PARTITION BY group_a, group_b ORDER BY score) - cb AS below FROM pooled
), statistics AS (
  SELECT group_a, group_b, sum(ca) AS n_a, sum(cb) AS n_b, sum(ca * (below + cb / 2)) AS u,
    sum((ca + cb) ** 3 - (ca + cb)) AS ties FROM running GROUP BY 1, 2
), tested AS (
  SELECT group_a, group_b, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, u AS u_statistic,
    (abs(u - n_a * n_b / 2) - 0.5e0) / sqrt(n_a * n_b / 12 * (n_a + n_b + 1
      - ties / ((n_a + n_b) * (n_a + n_b - 1)))) AS z FROM statistics
), normal AS (
  SELECT *, CASE WHEN z <= 0 THEN 1e0 ELSE 1 - 2 / sqrt(2 * pi()) * list_sum(list_transform(range(80),
    lambda i: (-1) ** i * exp((2 * i + 1) * ln(z) - i * ln(2e0) - lgamma(i + 1)) / (2 * i + 1))) END AS p
  FROM tested
)"""


@query("a23_mann_whitney", with_views(SCORED, PAIRS) + """
SELECT group_a, group_b, n_a, n_b, u_statistic, round(z, 8) AS z, round(p, 8) AS p_value FROM normal""")
def a23(spark, sf):
    df = ranktests.mann_whitney(views.scored(spark, sf), "score", "platform", PLATFORMS)
    return df.withColumns({"z": F.round("z", 8), "p_value": F.round("p_value", 8)})


@query("a24_w3_holm", with_views(SCORED, PAIRS) + """
SELECT group_a, group_b, round(p, 8) AS p_value, round(h, 8) AS p_value_holm,
  h < 0.05 AS significant_holm_0_05
FROM (SELECT *, max(a) OVER (ORDER BY p, group_a, group_b ROWS UNBOUNDED PRECEDING) AS h FROM (
  SELECT *, least(1e0, (11 - row_number() OVER (ORDER BY p, group_a, group_b)) * p) AS a FROM normal))""")
def a24(spark, sf):
    df = ranktests.holm(
        ranktests.mann_whitney(views.scored(spark, sf), "score", "platform", PLATFORMS))
    return df.select("group_a", "group_b", F.round("p_value", 8).alias("p_value"),
                     F.round("p_value_holm", 8).alias("p_value_holm"), "significant_holm_0_05")


# The Student-t tail by Simpson's rule on the density, 4000 steps up to |t|.
CORRELATION = """
scopes AS (
  SELECT coalesce(platform, 'overall') AS scope, corr(sentiment_score, toxicity_score) AS cr,
    count(*) AS n FROM posts GROUP BY GROUPING SETS ((platform), ())
), density AS (
  SELECT *, abs(cr) * sqrt((n - 2) / (1 - cr * cr)) AS t, CAST(n - 2 AS DOUBLE) AS v FROM scopes
), tails AS (
  SELECT scope, cr, n, 1 - 2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * t / 12000
    * list_sum(list_transform(range(4001), lambda i: (CASE WHEN i IN (0, 4000) THEN 1
      WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (1 + (t * i / 4000) ** 2 / v) ** (-(v + 1) / 2))) AS p
  FROM density
)"""


@query("a19_a20_correlations", with_views(POSTS, CORRELATION) + """
SELECT scope, round(cr, 4) AS r, round(p, 6) AS p_value, n FROM tails""")
def a19(spark, sf):
    df = correlation.correlations(
        views.posts(spark, sf), "platform", "sentiment_score", "toxicity_score")
    return df.withColumn("p_value", F.round("p_value", 6))


@query("a20_consistency", with_views(POSTS, CORRELATION) + """
SELECT min(round(cr, 4)) AS r_min, max(round(cr, 4)) AS r_max,
  max(round(cr, 4)) - min(round(cr, 4)) < 0.1 AS consistent_across_platforms
FROM scopes WHERE scope <> 'overall'""")
def a20(spark, sf):
    return correlation.consistency(correlation.correlations(
        views.posts(spark, sf), "platform", "sentiment_score", "toxicity_score"))


# TF-IDF and terms --------------------------------------------------------------------

def tfidf_sql(source: str, key: str, text: str, grams: int, features: int | None, min_df: int) -> str:
    pairs = f""" UNION ALL SELECT {key}, unnest(list_transform(range(1, len(w)),
        lambda i: w[i] || ' ' || w[i + 1])) FROM words""" if grams == 2 else ""
    top = f"ORDER BY total DESC, term LIMIT {features}" if features else ""
    return f"""words AS (
  SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {source}
), grams AS (SELECT {key}, unnest(w) AS term FROM words{pairs}
), tf AS (SELECT {key}, term, count(*) AS tf FROM grams GROUP BY 1, 2
), vocabulary AS (
  SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term HAVING count(*) >= {min_df} {top}
), weighted AS (
  SELECT {key}, term, tf, tf * (ln((1 + (SELECT count(*) FROM {source})) / CAST(1 + df AS DOUBLE)) + 1) AS w
  FROM tf JOIN vocabulary USING (term)
), tfidf AS (
  SELECT {key}, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM weighted
)"""


@query("m1_tfidf_relational", with_views(
    tfidf_sql("documents", "doc_id", "text", 2, 2000, 2)) + """
SELECT doc_id, term, tf, round(weight, 8) AS weight FROM tfidf""")
def m1(spark, sf):
    weights = terms.tfidf(views.table(spark, sf, "documents"), "doc_id", "text",
                          grams=2, max_features=2000, min_df=2)
    return weights.withColumn("weight", F.round("weight", 8))


@query("a36_w4_cluster_terms", with_views(
    tfidf_sql("documents", "doc_id", "text", 1, 2000, 2)) + """
SELECT lang, term, weight, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM (
    SELECT lang, term, round(sum(weight) / any_value(size), 6) AS weight
    FROM tfidf JOIN documents USING (doc_id)
    JOIN (SELECT lang, count(*) AS size FROM documents GROUP BY lang) USING (lang) GROUP BY 1, 2))
WHERE rank <= 8""")
def a36(spark, sf):
    docs = views.table(spark, sf, "documents")
    weights = terms.tfidf(docs, "doc_id", "text", max_features=2000, min_df=2)
    return terms.cluster_terms(weights, docs, "doc_id", "lang")


# Samples, splits, folds, limits -------------------------------------------------------

@query("o6_seeded_sample", """
SELECT event_id, event_type FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 1500""")
def o6(spark, sf):
    df = views.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.sample_rows(df, "event_id", 1500)


@query("o7_first_rows_per_label", with_views(POSTS) + """
SELECT sentiment_label, post_id, CAST(r AS INTEGER) AS row FROM (
  SELECT *, row_number() OVER (PARTITION BY sentiment_label ORDER BY post_id) AS r FROM posts)
WHERE r <= 2""")
def o7(spark, sf):
    df = views.posts(spark, sf).select("sentiment_label", "post_id")
    return sampling.first_per_label(df, "sentiment_label", "post_id")


@query("o1_o5_ranked_table", with_views(SCORED) + """
SELECT platform AS model, round(avg(score), 4) AS f1 FROM scored GROUP BY 1""")
def o5(spark, sf):
    table = views.scored(spark, sf).groupBy(F.col("platform").alias("model")).agg(
        F.round(F.avg("score"), 4).alias("f1"))
    return metrics.best_model(table, "f1")


@query("s17_model_table_export", with_views(SCORED) + """
SELECT platform AS model, round(avg(score), 4) AS f1 FROM scored GROUP BY 1""")
def s17(spark, sf):
    path = fresh_folder(spark, "s17")
    sinks.write_csv(o5(spark, sf), path)
    return files.read_csv(spark, path, columns("model string, f1 double"))


PLACED = """
placed AS (
  SELECT event_id, event_type, row_number() OVER (
      PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) - 1 AS pos,
    count(*) OVER (PARTITION BY event_type) AS size FROM events
)"""


@query("w8_stratified_split", with_views(PLACED) + """
SELECT event_id, event_type, pos < floor(size * 0.2e0 + 0.5e0) AS is_test FROM placed""")
def w8(spark, sf):
    df = views.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.stratified_split(df, "event_id", "event_type")


@query("w9_stratified_folds", with_views(PLACED) + """
SELECT event_id, event_type, CAST(pos % 5 AS INTEGER) AS fold FROM placed""")
def w9(spark, sf):
    df = views.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.folds(df, "event_id", 5, "event_type")


@query("w9b_plain_folds", """
SELECT doc_id, CAST((row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1) % 3 AS INTEGER) AS fold
FROM documents""")
def w9b(spark, sf):
    return sampling.folds(views.table(spark, sf, "documents").select("doc_id"), "doc_id", 3)
