"""Registered queries: features, models, tuning and clusters.

Models are fitted on whole tables.  Where SQL can state the result the query has a
check; fitted coefficients and trees have none.
"""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tonegauge import constants as K
from tonegauge.functions.labels import lookup
from tonegauge.learning import clustering, evaluation, hierarchy, tasks
from tonegauge.learning import features as fx
from tonegauge.learning import models as mx
from tonegauge.operators import describe, metrics, posts, sampling, terms
from tonegauge.plans import views
from tonegauge.plans.queries_posts import fresh_folder
from tonegauge.plans.queries_stats import tfidf_sql
from tonegauge.plans.registry import query
from tonegauge.plans.views import POSTS, TEXT_POSTS, with_views

TONES = {"en": "Neutral", "de": "Negative", "fr": "Positive", "es": "Positive"}


def tone_posts(spark, sf):
    """Documents with a three-class tone, a function of their language; no label table, so no text is joined."""
    return views.table(spark, sf, "documents").select(
        F.col("doc_id").alias("post_id"), F.col("text").alias("text_content"), F.col("lang").alias("language"),
        lookup(F.col("lang"), TONES).alias("sentiment_label"))


def coded_tone(spark, sf):
    return tasks.coded(tone_posts(spark, sf), "sentiment_label")


# Features -------------------------------------------------------------------------------

@query("m1_tfidf_pipeline", with_views(TEXT_POSTS, tfidf_sql("text_posts", "post_id", "text_content", 2, 5000, 20)) + """
SELECT post_id, count(term) AS terms, round(coalesce(sum(weight), 0), 6) AS total,
  round(coalesce(max(weight), 0), 6) AS top
FROM text_posts LEFT JOIN tfidf USING (post_id) GROUP BY post_id""")
def m1_pipeline(spark, sf):
    df = views.text_posts(spark, sf).select("post_id", "text_content")
    model = Pipeline(stages=fx.text_stages(min_df=20)).fit(df)
    values = vector_to_array(F.col("features"))
    arrays = model.transform(df).select("post_id", F.filter(values, lambda v: v > 0).alias("v"))
    return arrays.select(
        "post_id", F.size("v").cast("bigint").alias("terms"),
        F.round(F.aggregate("v", F.lit(0.0), lambda s, v: s + v), 6).alias("total"),
        F.round(F.coalesce(F.array_max("v"), F.lit(0.0)), 6).alias("top"))


@query("m2_truncated_svd")
def m2(spark, sf):
    df = views.text_posts(spark, sf).select("post_id", "text_content")
    model = Pipeline(stages=fx.reduced_text_stages(max_features=1000, components=20)).fit(df)
    return model.transform(df).select(
        "post_id", F.transform(vector_to_array("features"), lambda v: F.round(v, 6)).alias("components"))


@query("m2b_svd_keeps_length", with_views(TEXT_POSTS, tfidf_sql("text_posts", "post_id", "text_content", 1, 30, 1)) + """
SELECT post_id, round(sqrt(coalesce(sum(weight * weight), 0)), 4) AS length
FROM text_posts LEFT JOIN tfidf USING (post_id) GROUP BY post_id""")
def m2b(spark, sf):
    """With as many components as terms the projection keeps every document's length."""
    df = views.text_posts(spark, sf).select("post_id", "text_content")
    stages = [*fx.text_stages(out="tfidf", max_features=30, grams=1),
              fx.TruncatedSvd(inputCol="tfidf", outputCol="features", k=30)]
    reduced = Pipeline(stages=stages).fit(df).transform(df)
    square = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, v: s + v * v)
    return reduced.select("post_id", F.round(F.sqrt(square), 4).alias("length"))


@query("m3_impute_and_scale", with_views(TEXT_POSTS, """
filled AS (
  SELECT post_id, coalesce(CAST(quality AS DOUBLE), (SELECT quantile_cont(quality, 0.5) FROM labels)) AS q,
    CAST(n_chars AS DOUBLE) AS c, coalesce(mentions, (SELECT mentions FROM text_posts WHERE mentions IS NOT NULL
      GROUP BY mentions ORDER BY count(*) DESC, mentions LIMIT 1)) AS mentions_filled FROM text_posts
)""") + """
SELECT post_id, mentions_filled, round((q - (SELECT avg(q) FROM filled)) / (SELECT stddev_pop(q) FROM filled), 6)
    AS quality_scaled,
  round((c - (SELECT avg(c) FROM filled)) / (SELECT stddev_pop(c) FROM filled), 6) AS n_chars_scaled
FROM filled""")
def m3(spark, sf):
    df = views.text_posts(spark, sf).select("post_id", "quality", "n_chars", "mentions")
    stages = [fx.FillAndScale(inputCols=["quality", "n_chars"], fill="median"),
              fx.FillMostFrequent(inputCols=["mentions"])]
    out = Pipeline(stages=stages).fit(df).transform(df)
    return out.select("post_id", "mentions_filled", *[
        F.round(c, 6).alias(c) for c in ("quality_scaled", "n_chars_scaled")])


CONTEXT = """
context AS (
  SELECT post_id, toxicity_score, abs(sentiment_score) AS intensidad_sentimiento,
    CAST(CASE WHEN hashtags = '' THEN 0 ELSE len(string_split(hashtags, ',')) END AS DOUBLE) AS n_hashtags,
    CAST(mentions IS NOT NULL AS DOUBLE) AS tiene_mencion,
    CAST(day_of_week IN ('Saturday', 'Sunday') AS DOUBLE) AS es_fin_semana,
    CAST(hour("timestamp") BETWEEN 9 AND 18 AS DOUBLE) AS es_hora_laboral,
    user_past_sentiment_avg, user_engagement_growth, buzz_change_rate
  FROM posts WHERE engagement_rate <= 1
)"""


@query("m4_context_scaling", with_views(POSTS, CONTEXT) + "SELECT post_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in K.COHERENCE_FEATURES)
    + " FROM context")
def m4(spark, sf):
    df = tasks.coherence_table(views.posts(spark, sf))
    model = Pipeline(stages=fx.context_stages(K.COHERENCE_FEATURES)).fit(df)
    out = model.transform(df).withColumn("v", vector_to_array("features"))
    return out.select("post_id", *[
        F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(K.COHERENCE_FEATURES)])


@query("p30_label_codes", with_views(POSTS) + """
SELECT emotion_type, CAST(dense_rank() OVER (ORDER BY emotion_type) - 1 AS DOUBLE) AS label, count(*) AS n
FROM posts GROUP BY emotion_type""")
def p30(spark, sf):
    df, _ = tasks.coded(views.posts(spark, sf), "emotion_type")
    return df.groupBy("emotion_type", "label").agg(F.count(F.lit(1)).alias("n"))


# Classifiers ------------------------------------------------------------------------------

@query("m5_logistic_tone")
def m5(spark, sf):
    df, labels = coded_tone(spark, sf)
    train, test = tasks.split(df, "post_id")
    model = mx.pipeline(fx.text_stages(), mx.ScaledLogistic()).fit(train)
    return tasks.predictions(model, test, "post_id", labels)


# Naive Bayes is closed form: log prior plus weight times log of the smoothed class share.
@query("m6_naive_bayes_tone", with_views(
    tfidf_sql("documents", "doc_id", "text", 1, 5000, 5), """
tones AS (
  SELECT doc_id, CASE lang WHEN 'en' THEN 'Neutral' WHEN 'de' THEN 'Negative' ELSE 'Positive' END AS tone
  FROM documents
), shares AS (
  SELECT tone, term, sum(weight) AS s FROM tfidf JOIN tones USING (doc_id) GROUP BY 1, 2
), totals AS (SELECT tone, sum(s) + (SELECT count(*) FROM vocabulary) AS t FROM shares GROUP BY tone
), priors AS (
  SELECT tone, ln((count(*) + 1) / ((SELECT count(*) FROM tones) + 3e0)) AS p FROM tones GROUP BY tone
), joint AS (
  SELECT f.doc_id, p.tone, any_value(p.p) + sum(f.weight * ln((coalesce(s.s, 0) + 1) / t.t)) AS score
  FROM tfidf f CROSS JOIN priors p JOIN totals t ON t.tone = p.tone
  LEFT JOIN shares s ON s.tone = p.tone AND s.term = f.term GROUP BY 1, 2
)""") + """
SELECT t.doc_id AS post_id, t.tone AS label,
  coalesce((SELECT tone FROM joint j WHERE j.doc_id = t.doc_id ORDER BY score DESC LIMIT 1),
    (SELECT tone FROM priors ORDER BY p DESC LIMIT 1)) AS prediction FROM tones t""")
def m6(spark, sf):
    df, labels = coded_tone(spark, sf)
    stages = fx.text_stages(grams=1, min_df=5)
    model = mx.pipeline(stages, mx.naive_bayes()).fit(df)
    return tasks.predictions(model, df, "post_id", labels)


@query("m7_random_forest_tone")
def m7(spark, sf):
    df, labels = coded_tone(spark, sf)
    train, test = tasks.split(df, "post_id")
    model = mx.pipeline(fx.text_stages(), mx.random_forest()).fit(train)
    return tasks.predictions(model, test, "post_id", labels)


@query("m8_gradient_boosting_coherence")
def m8(spark, sf):
    train, test = tasks.split(tasks.coherence_table(views.posts(spark, sf)), "post_id")
    model = mx.pipeline(
        fx.context_stages(K.COHERENCE_FEATURES), mx.gradient_boosting()).fit(train)
    return model.transform(test).select("post_id", "label", "prediction")


@query("m9_linear_svc_emotion")
def m9(spark, sf):
    df, labels = tasks.coded(views.posts(spark, sf), "emotion_type")
    train, test = tasks.split(df, "post_id")
    model = mx.pipeline(
        fx.text_stages(grams=1), mx.ScaledLinearSvc()).fit(train)
    return tasks.predictions(model, test, "post_id", labels)


@query("m12_compare_tone_models")
def m12(spark, sf):
    df, _ = coded_tone(spark, sf)
    train, test = tasks.split(df, "post_id")
    return evaluation.compare_classifiers(
        spark, fx.text_stages(), tasks.tone_models(), train, test, "post_id", k=5)


@query("m13_emotion_models")
def m13(spark, sf):
    df, _ = tasks.coded(views.posts(spark, sf), "emotion_type")
    train, test = tasks.split(df, "post_id")
    return evaluation.compare_classifiers(
        spark, fx.text_stages(min_df=2), tasks.text_models(), train, test, "post_id", k=3)


@query("m14_synthetic_contrast")
def m14(spark, sf):
    df = views.posts(spark, sf)
    tone, _ = tasks.coded(df, "sentiment_label")
    toxic = df.withColumn("label", (F.col("toxicity_score") > K.TOXIC_THRESHOLD).cast("double"))
    return tasks.contrast(
        spark, {"sentiment": tone, "toxicity": toxic}, "post_id",
        lambda: mx.pipeline(fx.text_stages(min_df=2), mx.ScaledLogistic()))


@query("m15_cross_dataset_report")
def m15(spark, sf):
    source, labels = coded_tone(spark, sf)
    model = mx.pipeline(fx.text_stages(), mx.ScaledLogistic()).fit(source)
    talks = views.table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("post_id"), F.col("text").alias("text_content"),
        F.when(F.col("role") == "user", "Neutral").when(F.col("role") == "system", "Negative")
        .otherwise("Positive").alias("sentiment_label"))
    scored = model.transform(talks).withColumn("predicted", evaluation.class_name(labels))
    report = metrics.classification_report(scored, "sentiment_label", "predicted")
    gap = metrics.published_gap(metrics.macro_scores(scored, "sentiment_label", "predicted"))
    return report.crossJoin(F.broadcast(gap))  # one row


MANUAL = ["len_chars", "n_words", "n_exclaim", "n_question", "n_upper", "avg_word_len"]


@query("m16_j8_manual_feature_ablation")
def m16(spark, sf):
    df, _ = coded_tone(spark, sf)
    train, test = tasks.split(posts.add_manual_text_features(df), "post_id")
    f1 = tasks.manual_ablation(train, test, "text_content", MANUAL)
    return spark.createDataFrame([(name, round(v, 4)) for name, v in f1.items()], "scenario string, f1_macro double")


@query("m17_authentic_success_models")
def m17(spark, sf):
    df = tasks.success_table(views.posts(spark, sf))
    stages = fx.mixed_stages("text_content", tasks.SUCCESS_CATEGORIES, tasks.SUCCESS_NUMBERS)
    folds = evaluation.fold_measures(
        stages, tasks.weighted_models(), df, "post_id", 3, evaluation.classifier_measure, balance=True)
    measures = ("accuracy", "precision_macro", "recall_macro", "f1_macro")
    rows = [(name, *[round(sum(r[c] for r in found) / len(found), 4) for c in measures])
            for name, found in folds.items()]
    table = spark.createDataFrame(
        rows, "model string, accuracy double, precision_macro double, recall_macro double, f1_macro double")
    return metrics.best_model(table, "f1_macro")


@query("m18_coherence_models")
def m18(spark, sf):
    df = tasks.coherence_table(views.posts(spark, sf))
    models = tasks.weighted_models()
    folds = evaluation.fold_measures(
        fx.context_stages(K.COHERENCE_FEATURES), models, df, "post_id", 5, evaluation.classifier_measure, balance=True)
    rows = [(name, round(sum(r["f1_macro"] for r in found) / len(found), 4))
            for name, found in folds.items()]
    return metrics.best_model(spark.createDataFrame(rows, "model string, f1_macro double"), "f1_macro")


RULE = """
SELECT event_id, label, label AS prediction FROM (
  SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) >= 50 AS DOUBLE) AS label FROM events)
WHERE k < 40 OR k >= 60"""


def rule_posts(spark, sf):
    """Events whose label is a threshold of one feature, with a margin around it."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    df = views.table(spark, sf, "events").select("event_id", k.alias("k"), (k >= 50).cast("double").alias("label"))
    return df.where("k < 40 OR k >= 60").withColumn(
        "features", array_to_vector(F.array((F.floor(F.col("k") / 10) - 5).cast("double"))))


def learned_rule(spark, sf, model):
    df = rule_posts(spark, sf)
    return model.fit(df).transform(df).select("event_id", "label", "prediction")


@query("m5b_logistic_learns_rule", RULE)
def m5b(spark, sf):
    return learned_rule(spark, sf, mx.ScaledLogistic())


@query("m7b_forest_learns_rule", RULE)
def m7b(spark, sf):
    return learned_rule(spark, sf, mx.random_forest(trees=20, depth=4))


@query("m8b_boosting_learns_rule", RULE)
def m8b(spark, sf):
    return learned_rule(spark, sf, mx.gradient_boosting(rounds=10))


@query("m9b_linear_svc_learns_rule", RULE)
def m9b(spark, sf):
    return learned_rule(spark, sf, mx.ScaledLinearSvc())


@query("m5c_logistic_calibrated", """
SELECT CASE lang WHEN 'en' THEN 'Neutral' WHEN 'de' THEN 'Negative' ELSE 'Positive' END AS tone,
  count(*) AS n, true AS calibrated FROM documents GROUP BY 1""")
def m5c(spark, sf):
    """A free intercept makes the mean probability of a class its share of the training rows."""
    df, labels = coded_tone(spark, sf)
    model = mx.pipeline(fx.text_stages(max_features=200, grams=1), mx.ScaledLogistic()).fit(df)
    values = F.posexplode(vector_to_array("probability")).alias("i", "p")
    means = model.transform(df).select("label", values).withColumn("own", (F.col("label") == F.col("i")).cast("int"))
    return means.groupBy("i").agg(
        F.sum("own").alias("n"), (F.abs(F.avg("p") - F.avg("own")) < 0.01).alias("calibrated"),
    ).select(evaluation.class_name(labels, "i").alias("tone"), "n", "calibrated")


# Regressors -------------------------------------------------------------------------------

def engagement(spark, sf):
    return tasks.coherence_table(views.posts(spark, sf)).withColumn("label", F.col("log_engagement"))


@query("m19_m20_m21_engagement_regressors")
def m19(spark, sf):
    return evaluation.compare_regressors(
        spark, fx.context_stages(K.ENGAGEMENT_FEATURES), tasks.engagement_models(),
        engagement(spark, sf), "post_id", k=3)


@query("m22_predicted_against_actual")
def m22(spark, sf):
    df = sampling.shuffled_position(engagement(spark, sf), "post_id", None)
    cut = F.floor(F.col("_size") * 0.2 + 0.5)
    model = mx.pipeline(fx.context_stages(K.ENGAGEMENT_FEATURES), mx.ScaledRidge()).fit(
        df.where(F.col("_pos") >= cut))
    return model.transform(df.where(F.col("_pos") < cut)).select(
        "post_id", F.round("label", 6).alias("label"), F.round("prediction", 6).alias("prediction"))


@query("m21b_robust_line", """
SELECT event_id, CAST(event_id % 50 AS DOUBLE) * 2 + 1 AS label, CAST(event_id % 50 AS DOUBLE) * 2 + 1 AS prediction FROM events""")
def m21b(spark, sf):
    """Points on a line: the robust regression must return the line."""
    x = (F.col("event_id") % 50).cast("double")
    df = views.table(spark, sf, "events").select(
        "event_id", (x * 2 + 1).alias("label"), array_to_vector(F.array(x)).alias("features"))
    return mx.robust_linear().fit(df).transform(df).select("event_id", "label", F.round("prediction", 2).alias("prediction"))


@query("m19b_ridge_closed_form", """
WITH line AS (SELECT event_id, CAST(event_id % 50 AS DOUBLE) AS x, value AS y FROM events),
fit AS (SELECT sum((x - mx) * (y - my)) / (sum((x - mx) ** 2) + 1) AS b, any_value(mx) AS mx, any_value(my) AS my
  FROM line, (SELECT avg(x) AS mx, avg(y) AS my FROM line))
SELECT event_id, round(my + b * (x - mx), 4) AS prediction FROM line, fit""")
def m19b(spark, sf):
    x = (F.col("event_id") % 50).cast("double")
    df = views.table(spark, sf, "events").select(
        "event_id", F.col("value").alias("label"), array_to_vector(F.array(x)).alias("features"))
    return mx.ScaledRidge().fit(df).transform(df).select("event_id", F.round("prediction", 4).alias("prediction"))


# Tuning -----------------------------------------------------------------------------------

def tuned_pipeline():
    vectorizer = fx.text_stages()[0]
    logistic = mx.ScaledLogistic()
    return mx.SharedPipeline(stages=[vectorizer, logistic]), vectorizer, logistic


def tuning_grid(vectorizer, logistic):
    return [{logistic.C: c, vectorizer.grams: grams, vectorizer.maxFeatures: size}
            for c in (0.1, 1.0, 10.0) for grams in (1, 2) for size in (3000, 5000)]


@query("m23_m25_grid_search")
def m23(spark, sf):
    df, _ = tasks.coded(views.posts(spark, sf), "sentiment_label")
    estimator, vectorizer, logistic = tuned_pipeline()
    grid = tuning_grid(vectorizer, logistic)
    search = evaluation.cross_validate(estimator, df, "post_id", 5, evaluation.MacroF1(), grid)
    return evaluation.search_table(spark, search, grid)


@query("m24_m25_random_search_impact")
def m24(spark, sf):
    df, _ = tasks.coded(views.posts(spark, sf), "sentiment_label")
    train, test = tasks.split(df, "post_id")
    estimator, vectorizer, logistic = tuned_pipeline()
    draws = {logistic.C: lambda g: mx.log_uniform(g, 1e-2, 1e2),
             vectorizer.maxFeatures: [3000, 5000, 8000], vectorizer.grams: [1, 2]}
    searches = {
        "base": [{}],
        "grid search": tuning_grid(vectorizer, logistic),
        "random search": evaluation.random_grid(draws, 15),
    }
    return evaluation.tuning_impact(spark, estimator, searches, train, test, "post_id", 5)


# Texts that name their class: every candidate must learn them.
@query("m23b_grid_learns_names", """
SELECT DISTINCT 'C=' || c || ', grams=' || g || ', maxFeatures=' || m AS params, 1e0 AS cv_f1_mean, 0e0 AS cv_f1_std
FROM events, (SELECT unnest(['1.0', '100.0']) AS c), (SELECT unnest([1, 2]) AS g), (SELECT unnest([40, 60]) AS m)""")
def m23b(spark, sf):
    df, _ = naming_posts(spark, sf)
    estimator, vectorizer, logistic = tuned_pipeline()
    grid = [{logistic.C: c, vectorizer.grams: grams, vectorizer.maxFeatures: size}
            for c in (1.0, 100.0) for grams in (1, 2) for size in (40, 60)]
    search = evaluation.cross_validate(estimator, df, "post_id", 3, evaluation.MacroF1(), grid)
    return evaluation.search_table(spark, search, grid)


@query("m24b_search_finds_the_vocabulary", """
SELECT unnest(['base', 'grid search', 'random search']) AS method, unnest([true, false, false]) AS poor,
  unnest([false, true, true]) AS perfect FROM (SELECT count(*) FROM events)""")
def m24b(spark, sf):
    """Two terms can't name five classes; a search over larger vocabularies finds ones that do."""
    df, _ = naming_posts(spark, sf)
    train, test = tasks.split(df, "post_id")
    estimator, vectorizer, logistic = tuned_pipeline()
    two = {vectorizer.maxFeatures: 2, vectorizer.grams: 1}
    draws = {logistic.C: lambda g: mx.log_uniform(g, 1, 1e2), vectorizer.maxFeatures: [30, 50], vectorizer.grams: [1, 2]}
    searches = {"base": [two], "grid search": [{**two, logistic.C: c, vectorizer.maxFeatures: size}
                                               for c in (1.0, 10.0) for size in (2, 50)],
                "random search": evaluation.random_grid(draws, 4)}
    found = evaluation.tuning_impact(spark, estimator, searches, train, test, "post_id", 3)
    return found.select("method", (F.col("test_f1_macro") < 0.5).alias("poor"),
                        ((F.col("test_f1_macro") == 1) & (F.col("cv_f1_mean") == 1)).alias("perfect"))


@query("m26_class_terms")
def m26(spark, sf):
    df, labels = coded_tone(spark, sf)
    model = mx.pipeline(fx.text_stages(), mx.ScaledLogistic()).fit(df)
    return evaluation.class_terms(spark, model, labels)


# A text that names its class: every sound text model must learn it.
def naming_posts(spark, sf):
    e = views.table(spark, sf, "events")
    df = e.select(F.col("event_id").alias("post_id"), F.col("event_type").alias("sentiment_label"), F.concat(
        F.lit("about own"), "event_type", F.lit(" number n"), F.col("event_id") % 7).alias("text_content"))
    return tasks.coded(df, "sentiment_label")


@query("m26b_own_token_leads", """
SELECT DISTINCT event_type AS class, 1 AS rank, 'own' || lower(event_type) AS term FROM events""")
def m26b(spark, sf):
    df, labels = naming_posts(spark, sf)
    model = mx.pipeline(fx.text_stages(max_features=50, grams=1), mx.ScaledLogistic()).fit(df)
    return evaluation.class_terms(spark, model, labels, 1).drop("weight")


@query("m33c_scores_name_the_class", """
SELECT event_id AS post_id, event_type AS predicted_label, true AS agree FROM events""")
def m33c(spark, sf):
    df, labels = naming_posts(spark, sf)
    model = mx.pipeline(fx.text_stages(max_features=50, grams=1), mx.ScaledLogistic()).fit(df)
    scored = evaluation.score(model, df.select("post_id", "text_content"), labels)
    reference = df.select("post_id", F.col("sentiment_label").alias("reference_label"))
    return evaluation.compare_labels(scored, reference, "post_id").select("post_id", "predicted_label", "agree")


@query("m12b_models_learn_names", """
SELECT unnest(['logistic', 'naive_bayes', 'random_forest']) AS model, 1.0e0 AS cv_f1_mean, 1.0e0 AS test_accuracy,
  1.0e0 AS test_f1_macro FROM (SELECT count(*) FROM events)""")
def m12b(spark, sf):
    df, _ = naming_posts(spark, sf)
    train, test = tasks.split(df, "post_id")
    return evaluation.compare_classifiers(
        spark, fx.text_stages(max_features=50, grams=1), tasks.tone_models(trees=20), train, test, "post_id", k=2,
    ).select("model", "cv_f1_mean", "test_accuracy", "test_f1_macro")


# Clusters ---------------------------------------------------------------------------------

def vectors(spark, sf):
    return views.vectors(spark, sf).withColumn(
        "features", array_to_vector(F.col("embedding").cast("array<double>")))


@query("m27_kmeans_sweep")
def m27(spark, sf):
    return clustering.sweep_k(spark, vectors(spark, sf), "vec_id", [2, 3, 4, 5, 6])


@query("m28_bisecting_kmeans")
def m28(spark, sf):
    df = vectors(spark, sf)
    return clustering.bisecting(df, 6).transform(df).select("vec_id", "cluster")


# Far-apart groups made from events: any sound clustering must find them.
FAR = {"g": "event_id % 4", "x": "CAST(event_id % 2 AS DOUBLE) * 1000 + (event_id % 7) / 10.0e0",
       "y": "CAST(event_id % 4 // 2 AS DOUBLE) * 30 + (event_id % 5) / 10.0e0"}
FAR_SQL = f"""
WITH far AS (SELECT event_id, {FAR["g"]} AS g, {FAR["x"]} AS x, {FAR["y"]} AS y FROM events),
centre AS (SELECT g, avg(x) AS cx, avg(y) AS cy FROM far GROUP BY g)
SELECT min(event_id) AS first_id, count(*) AS n, round(sum((x - cx) ** 2 + (y - cy) ** 2), 3) AS inertia
FROM far JOIN centre USING (g) GROUP BY g"""


def far_groups(spark, sf):
    e = views.table(spark, sf, "events")
    columns = {k: F.expr(v.replace("//", "div").replace("0e0", "0D")) for k, v in FAR.items()}
    return e.select("event_id", *[v.alias(k) for k, v in columns.items()]).withColumn(
        "features", array_to_vector(F.array("x", "y")))


def far_report(members):
    centre = members.groupBy("cluster").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    square = (F.col("x") - F.col("cx")) ** 2 + (F.col("y") - F.col("cy")) ** 2
    return members.join(centre, "cluster").groupBy("cluster").agg(
        F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum(square), 3).alias("inertia")).drop("cluster")


@query("m27b_kmeans_far_groups", FAR_SQL)
def m27b(spark, sf):
    df = far_groups(spark, sf)
    return far_report(clustering.best_kmeans(df, 4).transform(df))


@query("m28b_bisecting_far_groups", FAR_SQL)
def m28b(spark, sf):
    df = far_groups(spark, sf)
    return far_report(clustering.bisecting(df, 4).transform(df))


@query("m28_ward_clusters")
def m28_ward(spark, sf):
    return hierarchy.ward(vectors(spark, sf), 6).select("vec_id", "cluster")


@query("m28c_ward_far_groups", FAR_SQL)
def m28c(spark, sf):
    return far_report(hierarchy.ward(far_groups(spark, sf), 4))


# Days lie 10 ** day apart, so the tree adds one day after the other to the first.
@query("m28d_ward_tree_of_days", """
WITH posts AS (SELECT isodow(CAST(ts AS TIMESTAMP)) AS day FROM events),
days AS (SELECT day, CAST(count(*) AS DOUBLE) AS n, 10.0e0 ** day AS x FROM posts GROUP BY day),
sums AS (SELECT day, n, x, sum(n) OVER w AS m, sum(n * x) OVER w / sum(n) OVER w AS c, row_number() OVER (ORDER BY day) AS r
  FROM days WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT CAST(r - 2 AS INTEGER) AS step, CAST(n + m AS BIGINT) AS n_rows,
  round(sqrt(2 * n * m / (n + m)) * abs(x - c), 3) AS height FROM sums WHERE r > 1""")
def m28d(spark, sf):
    day = F.weekday(F.col("ts").cast("timestamp")) + 1
    df = views.table(spark, sf, "events").select(F.array(F.pow(F.lit(10.0), day)).alias("features"))
    return hierarchy.ward_tree(df).select("step", "n_rows", F.round("height", 3).alias("height"))


NEIGHBOURS = """
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b
  ON list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) <= 1.09
), core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 3
), links AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)
), reach AS (
  SELECT id AS node, id AS root FROM core
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node
), numbered AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS c
  FROM (SELECT DISTINCT root FROM roots)
), assigned AS (
  SELECT e.vec_id, coalesce((SELECT root FROM roots WHERE node = e.vec_id),
    (SELECT min(root) FROM near JOIN roots ON node = b WHERE a = e.vec_id)) AS root FROM embeddings e
)"""


@query("m29_density_clusters", with_views(NEIGHBOURS).replace("WITH", "WITH RECURSIVE", 1) + """
SELECT vec_id, coalesce(c, -1) AS cluster FROM assigned LEFT JOIN numbered USING (root)""")
def m29(spark, sf):
    found = clustering.dbscan(views.vectors(spark, sf), "vec_id", "embedding", 1.09, 3)
    return found.select("vec_id", "cluster")


@query("m29b_density_clusters_of_posts")
def m29b(spark, sf):
    df = views.posts(spark, sf).select("post_id", F.array(
        F.col("sentiment_score") * 10, F.log1p("engagement_rate") * 10).alias("features"))
    found = clustering.dbscan(df, "post_id", "features", 0.1, 20)
    return clustering.noise_rate(found)


@query("m30_w7_pca_variance")
def m30(spark, sf):
    df = tasks.coherence_table(views.posts(spark, sf))
    scaled = Pipeline(stages=fx.context_stages(K.COHERENCE_FEATURES)).fit(df).transform(df)
    out = clustering.pca_variance(scaled, "features", len(K.COHERENCE_FEATURES))
    return out.select("component", F.round("variance", 6).alias("variance"),
                      F.round("cumulative", 6).alias("cumulative"))


@query("m30b_pca_invariants", with_views(POSTS, CONTEXT) + "SELECT 1.0e0 AS total, round((" + " + ".join(
    f"coalesce(corr({a}, {b}), 0) ** 2" for a in K.COHERENCE_FEATURES for b in K.COHERENCE_FEATURES)
    + f") / {len(K.COHERENCE_FEATURES) ** 2}, 5) AS squares FROM context")
def m30b(spark, sf):
    """Shares of variance sum to 1, their squares to the mean squared correlation."""
    df = tasks.coherence_table(views.posts(spark, sf))
    scaled = Pipeline(stages=fx.context_stages(K.COHERENCE_FEATURES)).fit(df).transform(df)
    out = clustering.pca_variance(scaled, "features", len(K.COHERENCE_FEATURES))
    return out.agg(F.round(F.sum("variance"), 6).alias("total"),
                   F.round(F.sum(F.col("variance") ** 2), 5).alias("squares"))


# Two columns: the eigenvalues of their covariances have a closed form.
@query("m30d_w7_running_variance", f"""
WITH far AS (SELECT {FAR["x"]} AS x, {FAR["y"]} AS y FROM events),
c AS (SELECT var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS ab FROM far),
e AS (SELECT (a + b) / 2 + sqrt(((a - b) / 2) ** 2 + ab ** 2) AS high, a + b AS total FROM c)
SELECT 1 AS component, round(high / total, 6) AS variance, round(high / total, 6) AS cumulative FROM e
UNION ALL SELECT 2, round(1 - high / total, 6), 1.0e0 FROM e""")
def m30d(spark, sf):
    shares = clustering.pca_variance(far_groups(spark, sf), "features", 2)
    return shares.select("component", F.round("variance", 6).alias("variance"),
                         F.round("cumulative", 6).alias("cumulative"))


@query("m30c_pca_projection", with_views(POSTS, CONTEXT) + "SELECT post_id, round(" + " + ".join(
    f"pow(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 2)" for c in K.COHERENCE_FEATURES)
    + ", 4) AS square FROM context")
def m30c(spark, sf):
    """Coordinates on all components keep the length of every row."""
    df = tasks.coherence_table(views.posts(spark, sf))
    scaled = Pipeline(stages=fx.context_stages(K.COHERENCE_FEATURES)).fit(df).transform(df)
    out = clustering.pca_project(scaled, "features", len(K.COHERENCE_FEATURES))
    square = F.aggregate(vector_to_array("projected"), F.lit(0.0), lambda s, v: s + v * v)
    return out.select("post_id", F.round(square, 4).alias("square"))


def silhouette_sql(source: str) -> str:
    """Silhouette by squared distances of ``source`` (c, x): sizes, sums and norms per cluster."""
    return f"""
points AS (SELECT row_number() OVER () AS id, c, x, list_dot_product(x, x) AS xx FROM ({source})
), sizes AS (SELECT c, count(*) AS n, sum(xx) AS q FROM points GROUP BY c
), sums AS (
  SELECT c, list(v ORDER BY i) AS s FROM (
    SELECT c, i, sum(v) AS v FROM (SELECT c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM points) GROUP BY 1, 2)
  GROUP BY c
), totals AS (
  SELECT id, p.c AS own, s.c AS other, n, greatest(n * xx + q - 2 * list_dot_product(x, s), 0) AS total
  FROM points p, sizes s JOIN sums USING (c)
), widths AS (
  SELECT id, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
    min(CASE WHEN own <> other THEN total / n END) AS b FROM totals GROUP BY id
)"""


@query("a32_silhouette", with_views(silhouette_sql(
    "SELECT label AS c, CAST(embedding AS DOUBLE[]) AS x FROM embeddings")) + """
SELECT CAST((SELECT count(*) FROM sizes) AS INTEGER) AS n_clusters, count(*) AS n_points,
  round(avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 4) AS silhouette FROM widths""")
def a32(spark, sf):
    return clustering.silhouette(views.vectors(spark, sf), "label", "embedding")


@query("m31_cluster_evaluation")
def m31(spark, sf):
    df = vectors(spark, sf)
    members = clustering.best_kmeans(df, 6).transform(df)
    return clustering.evaluate_clusters(members, "cluster", "label")


def topics(spark, sf, df):
    stages = fx.text_stages(max_features=1000, stopwords=True, min_df=2)
    prepared = Pipeline(stages=stages).fit(df).transform(df)
    return clustering.best_kmeans(prepared, 6).transform(prepared)


@query("m32_tone_by_topic")
def m32(spark, sf):
    df, labels = coded_tone(spark, sf)
    df = df.select("post_id", "text_content", "label")
    model = mx.pipeline(fx.text_stages(), mx.ScaledLogistic()).fit(df)
    tone = model.transform(df).select("post_id", evaluation.class_name(labels).alias("tono_pred"))
    both = topics(spark, sf, df).select(
        "post_id", lookup(F.col("cluster"), K.TOPIC_NAMES).alias("tema_nombre")).join(tone, "post_id")
    return describe.crosstab(both, "tema_nombre", "tono_pred", labels, normalise=True)


@query("a36b_topic_terms")
def a36b(spark, sf):
    df = views.text_posts(spark, sf).select("post_id", "text_content")
    members = topics(spark, sf, df).select("post_id", "cluster")
    weights = terms.tfidf(df, "post_id", "text_content", grams=2, max_features=1000, min_df=2)
    return terms.cluster_terms(weights, members, "post_id", "cluster")


@query("m3b_column_transformer", with_views(TEXT_POSTS, """
filled AS (
  SELECT post_id, coalesce(mentions, (SELECT mentions FROM text_posts WHERE mentions IS NOT NULL
    GROUP BY mentions ORDER BY count(*) DESC, mentions LIMIT 1)) AS mention, language,
    (n_chars - avg(n_chars) OVER ()) / stddev_pop(n_chars) OVER () AS scaled FROM text_posts
)""") + """
SELECT post_id, (SELECT count(DISTINCT mention) FROM filled) + (SELECT count(DISTINCT language) FROM filled) AS columns,
  CAST(2 AS BIGINT) AS ones, round(scaled, 6) AS scaled FROM filled""")
def m3b(spark, sf):
    """Most frequent value for missing categories, one column per category, standard scaling."""
    df = views.text_posts(spark, sf).select("post_id", "text_content", "mentions", "language", "n_chars")
    stages = fx.mixed_stages("text_content", ["mentions", "language"], ["n_chars"], max_features=10)
    model = Pipeline(stages=stages).fit(df)
    parts = [vector_to_array(f"{c}_onehot") for c in ("mentions", "language")]
    both = F.concat(*parts)
    return model.transform(df).select(
        "post_id", F.size(both).cast("bigint").alias("columns"),
        F.aggregate(both, F.lit(0.0), lambda s, v: s + v).cast("bigint").alias("ones"),
        F.round("n_chars_scaled", 6).alias("scaled"))


# Scoring ----------------------------------------------------------------------------------

def scored_documents(spark, sf):
    df, labels = coded_tone(spark, sf)
    model = mx.pipeline(fx.text_stages(), mx.ScaledLogistic()).fit(df)
    items = df.select("post_id", "text_content", "sentiment_label")
    return evaluation.score(model, items, labels)


@query("m33_p35_batch_scoring")
def m33(spark, sf):
    return scored_documents(spark, sf).select("post_id", "predicted_label", "probabilities")


@query("m33b_probabilities_sum_to_one", "SELECT count(*) AS scored, count(*) AS sums_to_one FROM documents")
def m33b(spark, sf):
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda s, v: s + v)
    return scored_documents(spark, sf).agg(
        F.count(F.lit(1)).alias("scored"),
        F.count(F.when(F.abs(total - 1) < 0.001, 1)).alias("sums_to_one"))


@query("m34_compare_labels")
def m34(spark, sf):
    scored = scored_documents(spark, sf)
    reference = scored.select("post_id", F.col("sentiment_label").alias("reference_label"))
    return evaluation.compare_labels(scored, reference, "post_id").select(
        "post_id", "predicted_label", "reference_label", "agree")


@query("s18_save_and_reload", "SELECT count(*) AS scored, count(*) AS same_label FROM documents")
def s18(spark, sf):
    path = fresh_folder(spark, "s18")
    df, _ = coded_tone(spark, sf)

    def train() -> PipelineModel:
        return mx.pipeline(fx.text_stages(), mx.naive_bayes()).fit(df)

    first = evaluation.load_or_train(path, train)
    second = evaluation.load_or_train(path, train)
    both = first.transform(df).select("post_id", F.col("prediction").alias("a")).join(
        second.transform(df).select("post_id", F.col("prediction").alias("b")), "post_id")
    return both.agg(F.count(F.lit(1)).alias("scored"),
                    F.count(F.when(F.col("a") == F.col("b"), 1)).alias("same_label"))
