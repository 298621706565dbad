"""Registered queries: classification, agreement and clustering metrics, baselines."""

from pyspark.sql import functions as F

from tonegauge.operators import metrics, sampling
from tonegauge.plans import views
from tonegauge.plans.registry import query
from tonegauge.plans.views import POSTS, TWO_MODELS, with_views

ZERO_ONE = ["0", "1"]

CONFUSION = """
SELECT CAST(p AS INTEGER) AS position, l AS label,
  count(*) FILTER (true_label = l AND model_a = '0') AS pred_0,
  count(*) FILTER (true_label = l AND model_a = '1') AS pred_1
FROM two_models, (SELECT unnest([0, 1]) AS p, unnest(['0', '1']) AS l) GROUP BY 1, 2"""


@query("a25_confusion_matrix", with_views(TWO_MODELS) + CONFUSION)
def a25(spark, sf):
    return metrics.confusion_matrix(views.two_models(spark, sf), "true_label", "model_a", ZERO_ONE)


@query("a26_confusion_shares", with_views(TWO_MODELS) + """
SELECT position, label, round(100e0 * pred_0 / (pred_0 + pred_1), 2) AS pred_0,
  round(100e0 * pred_1 / (pred_0 + pred_1), 2) AS pred_1 FROM (""" + CONFUSION + ")")
def a26(spark, sf):
    matrix = metrics.confusion_matrix(views.two_models(spark, sf), "true_label", "model_a", ZERO_ONE)
    return metrics.confusion_share(matrix, ZERO_ONE)


@query("a26b_binary_cells", with_views(TWO_MODELS) + """
SELECT count(*) FILTER (true_label = '0' AND model_b = '0') AS tn,
  count(*) FILTER (true_label = '0' AND model_b = '1') AS fp,
  count(*) FILTER (true_label = '1' AND model_b = '0') AS fn,
  count(*) FILTER (true_label = '1' AND model_b = '1') AS tp FROM two_models""")
def a26b(spark, sf):
    return metrics.binary_cells(views.two_models(spark, sf), "true_label", "model_b", "0", "1")


def scores_sql(source: str, truth: str, guess: str, tag: str = "") -> str:
    """Common table expressions ending in ``classes{tag}``."""
    return f"""
cells{tag} AS (
  SELECT CAST({truth} AS VARCHAR) AS t, CAST({guess} AS VARCHAR) AS g, count(*) AS n FROM {source}
  WHERE {truth} IS NOT NULL AND {guess} IS NOT NULL GROUP BY 1, 2
), names{tag} AS (SELECT t AS label FROM cells{tag} UNION SELECT g FROM cells{tag}
), sums{tag} AS (
  SELECT label, CAST(coalesce((SELECT sum(n) FROM cells{tag} WHERE t = label AND g = label), 0) AS DOUBLE) AS tp,
    CAST(coalesce((SELECT sum(n) FROM cells{tag} WHERE g = label), 0) AS DOUBLE) AS predicted,
    CAST(coalesce((SELECT sum(n) FROM cells{tag} WHERE t = label), 0) AS DOUBLE) AS actual FROM names{tag}
), classes{tag} AS (
  SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
    CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS r,
    CASE WHEN predicted + actual > 0 THEN 2 * tp / (predicted + actual) ELSE 0 END AS f,
    actual, tp FROM sums{tag}
)"""


@query("a27_classification_report", with_views(POSTS, scores_sql("posts", "emotion_type", "campaign_phase")) + """
SELECT label, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1,
  CAST(actual AS BIGINT) AS support FROM classes
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(actual), 4), round(sum(tp) / sum(actual), 4),
  round(sum(tp) / sum(actual), 4), CAST(sum(actual) AS BIGINT) FROM classes
UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4),
  CAST(sum(actual) AS BIGINT) FROM classes
UNION ALL SELECT 'weighted avg', round(sum(p * actual) / sum(actual), 4),
  round(sum(r * actual) / sum(actual), 4), round(sum(f * actual) / sum(actual), 4),
  CAST(sum(actual) AS BIGINT) FROM classes""")
def a27(spark, sf):
    return metrics.classification_report(views.posts(spark, sf), "emotion_type", "campaign_phase")


@query("a27b_report_of_two_classes", with_views(TWO_MODELS, scores_sql("two_models", "true_label", "model_b")) + """
SELECT label, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1,
  CAST(actual AS BIGINT) AS support FROM classes""")
def a27b(spark, sf):
    report = metrics.classification_report(views.two_models(spark, sf), "true_label", "model_b")
    return report.where(F.col("label").isin(ZERO_ONE))


@query("a28_macro_scores", with_views(TWO_MODELS, scores_sql("two_models", "true_label", "model_a")) + """
SELECT CAST(sum(actual) AS BIGINT) AS n, round(sum(tp) / sum(actual), 6) AS accuracy,
  round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f), 6) AS f1_macro
FROM classes""")
def a28(spark, sf):
    scores = metrics.macro_scores(views.two_models(spark, sf), "true_label", "model_a")
    return scores.select("n", *[F.round(c, 6).alias(c) for c in scores.columns[1:]])


@query("a29_agreement", with_views(TWO_MODELS) + """
SELECT count(*) AS n_samples, round(avg(CAST(model_a = model_b AS INTEGER)), 4) AS agreement_rate
FROM two_models""")
def a29(spark, sf):
    return metrics.agreement(views.two_models(spark, sf), "model_a", "model_b")


@query("a30_model_benchmark", with_views(
    TWO_MODELS, scores_sql("two_models", "true_label", "model_a", "_a"),
    scores_sql("two_models", "true_label", "model_b", "_b")) + """
SELECT count(*) AS n_samples, round(avg(CAST(model_a = model_b AS INTEGER)), 4) AS agreement_rate,
  (SELECT round(avg(f), 4) FROM classes_a) AS f1_macro_first,
  (SELECT round(avg(f), 4) FROM classes_b) AS f1_macro_second,
  'macro-F1 against the given labels' AS note FROM two_models""")
def a30(spark, sf):
    return metrics.model_benchmark(views.two_models(spark, sf), "true_label", "model_a", "model_b")


@query("a30b_benchmark_without_labels", """
SELECT count(*) AS n_samples, round(avg(CAST(coalesce(lang = source, false) AS INTEGER)), 4) AS agreement_rate,
  CAST(NULL AS DOUBLE) AS f1_macro_first, CAST(NULL AS DOUBLE) AS f1_macro_second,
  'labels incomplete: agreement only' AS note FROM documents""")
def a30b(spark, sf):
    df = views.text_posts(spark, sf)
    return metrics.model_benchmark(df, "quality", "language", "brand_name")


@query("a31_cluster_agreement", with_views("""
cells AS (SELECT lang AS l, source AS c, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY 1, 2
), a AS (SELECT l, sum(n) AS n FROM cells GROUP BY l
), b AS (SELECT c, sum(n) AS n FROM cells GROUP BY c
), s AS (
  SELECT (SELECT sum(n) FROM cells) AS t, (SELECT sum(n * (n - 1) / 2) FROM cells) AS i,
    (SELECT sum(n * (n - 1) / 2) FROM a) AS x, (SELECT sum(n * (n - 1) / 2) FROM b) AS y,
    (SELECT -sum(n / q * ln(n / q)) FROM a, (SELECT sum(n) AS q FROM a)) AS ha,
    (SELECT -sum(n / q * ln(n / q)) FROM b, (SELECT sum(n) AS q FROM b)) AS hb,
    (SELECT -sum(n / q * ln(n / q)) FROM cells, (SELECT sum(n) AS q FROM cells)) AS hc
)""") + """
SELECT (SELECT count(*) FROM b) AS n_clusters,
  round((i - x * y / (t * (t - 1) / 2)) / ((x + y) / 2 - x * y / (t * (t - 1) / 2)), 4) AS ari,
  round((ha + hb - hc) / ((ha + hb) / 2), 4) AS nmi FROM s""")
def a31(spark, sf):
    return metrics.cluster_agreement(views.table(spark, sf, "documents"), "source", "lang")


@query("a33_regression_scores", with_views(POSTS) + """
SELECT count(*) AS n, round(sqrt(avg((likes_count - shares_count) ** 2)), 6) AS rmse,
  round(1 - avg((likes_count - shares_count) ** 2) / var_pop(likes_count), 6) AS r2 FROM posts""")
def a33(spark, sf):
    scores = metrics.regression_scores(views.posts(spark, sf), "likes_count", "shares_count")
    return scores.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


RANDOM = """
prior AS (
  SELECT lab, sum(n) OVER (ORDER BY lab) / sum(n) OVER () AS upto FROM (
    SELECT quality AS lab, CAST(count(*) AS DOUBLE) AS n FROM labels GROUP BY 1)
), drawn AS (
  SELECT doc_id, quality,
    CAST('0x' || substr(md5('42:' || doc_id), 1, 12) AS BIGINT) / 281474976710656e0 AS u FROM labels
), random AS (
  SELECT doc_id, quality, (SELECT min(lab) FROM prior WHERE upto > u) AS prediction FROM drawn
)"""


def random_predictions(spark, sf):
    labels = views.table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.random_by_prior(labels, labels, "doc_id", "quality")


@query("m11_baselines", with_views(RANDOM) + """
SELECT doc_id, quality, prediction AS random_class,
  (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1) AS majority_class
FROM random""")
def m11(spark, sf):
    labels = views.table(spark, sf, "labels")
    majority = sampling.majority_class(labels, "quality").select(
        F.col("prediction").alias("majority_class"))
    return random_predictions(spark, sf).withColumnRenamed("prediction", "random_class").crossJoin(
        F.broadcast(majority))  # one row


@query("a34_signal_test", with_views(
    RANDOM, TWO_MODELS, scores_sql("two_models", "true_label", "model_b", "_m"),
    scores_sql("random", "quality", "prediction", "_r")) + """
SELECT round(m, 4) AS f1_model, round(r, 4) AS f1_baseline, round(m - r, 4) AS gain, m - r > 0.05 AS has_signal
FROM (SELECT (SELECT avg(f) FROM classes_m) AS m, (SELECT avg(f) FROM classes_r) AS r)""")
def a34(spark, sf):
    model = metrics.macro_scores(views.two_models(spark, sf), "true_label", "model_b")
    baseline = metrics.macro_scores(random_predictions(spark, sf), "quality", "prediction")
    return metrics.signal_test(model, baseline)


@query("a35_published_gap", with_views(TWO_MODELS, scores_sql("two_models", "true_label", "model_a")) + """
SELECT round(avg(f), 4) AS f1_macro_on_real_data, round(0.9366e0 - avg(f), 4) AS gap FROM classes""")
def a35(spark, sf):
    return metrics.published_gap(
        metrics.macro_scores(views.two_models(spark, sf), "true_label", "model_a"))


@query("m10_balanced_weights", with_views(TWO_MODELS) + """
SELECT item_id, true_label, round(t / (k * n), 9) AS weight FROM (
  SELECT item_id, true_label, CAST(count(*) OVER () AS DOUBLE) AS t,
    CAST(count(*) OVER (PARTITION BY true_label) AS DOUBLE) AS n FROM two_models),
  (SELECT count(DISTINCT true_label) AS k FROM two_models)""")
def m10(spark, sf):
    df = views.two_models(spark, sf).select("item_id", "true_label")
    return sampling.balanced_weights(df, "true_label").withColumn("weight", F.round("weight", 9))
