"""Null, NaN, tie and empty-value rules, on a few inline rows."""

import math

import pytest
from pyspark.sql import functions as F

from tonegauge import constants as K
from tonegauge.functions import labels, special, text
from tonegauge.functions.coerce import first_present, nan_to_null, to_number
from tonegauge.operators import describe, joins, metrics, ordering, posts, quality, ranktests, sampling, terms
from tonegauge.plans import etl, views
from tonegauge.schemas import RAW_POSTS, schema_drift


def column(df, name):
    return [r[name] for r in df.collect()]


def test_bad_numbers_and_nan_become_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (None,), ("",)], "v string")
    assert column(df.select(to_number("v").alias("v")), "v") == [1.5, None, None, None, None]
    floats = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert column(nan_to_null(floats), "v") == [None, 2.0]


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("2024-03-02 10:00:00",), ("soon",)], "timestamp string")
    out = posts.add_calendar(posts.parse_timestamp(df)).collect()
    assert [r["hour"] for r in out] == [10, None]


def test_unknown_rate_is_not_fake(spark):
    df = spark.createDataFrame([(None,), (1.0,), (1.01,), (-2.0,)], "engagement_rate double")
    out = posts.add_engagement_flags(df).collect()
    assert [r["fake_engagement_flag"] for r in out] == [0, 0, 1, 0]
    assert [round(r["log_engagement"], 6) for r in out] == [0.0, 0.30103, 0.303196, 0.0]


def test_source_without_rate_has_no_fake_posts(spark):
    df = spark.createDataFrame([("a",)], "post_id string")
    assert column(posts.add_engagement_flags(df), "fake_engagement_flag") == [0]


def test_interactions_and_zero_impressions(spark):
    df = spark.createDataFrame(
        [(1.0, None, 2, 0), (1.0, 3.0, 2, 4)],
        "likes_count double, shares_count double, comments_count bigint, impressions bigint")
    out = posts.add_recalculated_rate(posts.add_total_interactions(df)).collect()
    assert [r["total_interactions"] for r in out] == [3.0, 6.0]
    assert [r["er_recalc_ev3"] for r in out] == [None, 1.5]
    strict = posts.add_total_interactions(df, null_as_zero=False)
    assert column(strict, "total_interactions") == [None, 6.0]


def test_success_without_organic_posts(spark):
    df = spark.createDataFrame([(5.0, 0.5, 0.1)], "engagement_rate double, sentiment_score double, toxicity_score double")
    out = posts.flag_authentic_success(posts.add_engagement_flags(df))
    assert column(out, "authentic_success_ev3") == [0]


def test_text_counts_of_empty_and_missing_text(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("", "", ""), ("Hi  there? Yes!", "#a,#b", "@x @y")],
        "text_content string, hashtags string, mentions string")
    out = posts.add_text_counts(df).collect()
    assert [tuple(r)[3:] for r in out] == [(0, 0, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0), (15, 3, 2, 2, 1, 1)]


def test_hashtag_items_keep_empty_parts(spark):
    df = spark.createDataFrame([("a,b,",), ("",), (None,), ("x",)], "hashtags string")
    assert column(df.select(text.item_count(F.col("hashtags")).alias("n")), "n") == [3, 0, 0, 1]


def test_mean_word_length(spark):
    df = spark.createDataFrame([("ab cdef",), ("  ",), (None,)], "text_content string")
    assert column(posts.add_manual_text_features(df), "avg_word_len") == [3.0, 0.0, 0.0]


def test_terms_and_tokens(spark):
    df = spark.createDataFrame([("The NIÑO ate a red-hot chilli, at 10",)], "t string")
    row = df.select(text.terms(F.col("t")).alias("terms"), text.tokens(F.col("t")).alias("tokens"),
                    text.with_pairs(text.tokens(F.col("t"))).alias("grams")).first()
    assert row["terms"] == ["niño", "ate", "red", "hot", "chilli"]
    assert row["tokens"] == ["the", "niño", "ate", "red", "hot", "chilli", "at", "10"]
    assert row["grams"][8:10] == ["the niño", "niño ate"] and len(row["grams"]) == 15


def test_tokens_beyond_ascii(spark):
    sample = "Ünïcode_9 x ab\u0301c Я да 東京 ١٢ a1 \u00b2\u00b3 _"
    df = spark.createDataFrame([(sample,)], "t string")
    plain = F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    row = df.select(text.tokens(F.col("t")).alias("fast"), plain.alias("plain")).first()
    assert row["fast"] == row["plain"] and "ünïcode_9" in row["fast"] and "東京" in row["fast"]


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([("one",), ("",)], "t string")
    grams = column(df.select(text.with_pairs(text.tokens(F.col("t"))).alias("g")), "g")
    assert grams == [["one"], []]


def test_tweet_and_label_forms(spark):
    df = spark.createDataFrame([("@ana see https://x.y/z?q now",)], "t string")
    assert column(df.select(text.normalise_tweet(F.col("t")).alias("t")), "t") == ["@user see http now"]
    names = spark.createDataFrame([("LABEL_2",), (" Negative ",), ("mixed Mood",), (None,)], "l string")
    got = column(names.select(labels.canonical_label(F.col("l")).alias("l")), "l")
    assert got == ["Positive", "Negative", "Mixed mood", None]


def test_coherence_of_unknowns(spark):
    df = spark.createDataFrame(
        [("Positive", 0.5), ("Positive", None), ("Negative", 0.31), ("Neutral", None), (None, 0.1)],
        "label string, tox double")
    out = df.select(labels.coherence(F.col("label"), F.col("tox")).alias("c"))
    assert column(out, "c") == [0, 0, 1, 1, 0]


def test_platform_detection_by_share_of_numbers(spark):
    coded = spark.createDataFrame([("0.0",), ("3",), ("1",), ("twitter",), ("7",)], "platform string")
    assert sorted(column(posts.map_platforms(coded), "platform_name")) == ["reddit", "youtube"]
    named = spark.createDataFrame([(" Reddit",), ("2",), ("reference",), ("YouTube",)], "platform string")
    assert sorted(column(posts.map_platforms(named), "platform_name")) == ["reddit", "youtube"]


def test_campaign_join_matches_missing_names(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "campaign_name string, id int")
    dim = spark.createDataFrame([("a", "x"), (None, "y")], "campaign_name string, objective string")
    out = {r["id"]: r["objective"] for r in joins.attach_campaigns(df, dim).collect()}
    assert out == {1: "x", 2: "y", 3: None}


def test_provisional_campaigns_equal_published_rows(spark):
    # The published dimension, first four and last two of its 23 names.
    names = """BackToSchool BlackFriday CustomerFirst CyberMonday DigitalTransformation EarthDay
        FallCollection GlobalCampaign HolidaySpecial InnovationX LaunchWave LocalTouchpoints
        LoyaltyRewards NewYearNewYou NextGeneration PowerRelease ReferralBonus SpringBlast2025
        SummerDreams SummerSale SustainableFuture ValentinesDeals WinterWonders""".split()
    df = spark.createDataFrame([(n,) for n in names * 2] + [(None,)], "campaign_name string")
    out = {r[0]: tuple(r)[1:5] for r in joins.provisional_campaigns(df).collect()}
    assert len(out) == 23
    assert out["BackToSchool"] == ("awareness", "masivo", 8000, "alta")
    assert out["BlackFriday"] == ("conversion", "joven", 9750, "media")
    assert out["CustomerFirst"] == ("retention", "premium", 11500, "baja")
    assert out["CyberMonday"] == ("launch", "tecnico", 13250, "alta")
    assert out["ValentinesDeals"] == ("conversion", "joven", 44750, "alta")
    assert out["WinterWonders"] == ("retention", "premium", 46500, "media")


def test_first_and_last_row_per_key(spark):
    df = spark.createDataFrame(
        [(1, 2, "b", 0.5), (1, 1, "a", 0.1), (2, 1, None, 0.2), (3, 1, "c", None)],
        "comment_id int, seq int, platform string, hate_speech_score double")
    assert column(joins.dedup_comments(df, "seq"), "platform") == ["a"]
    old = spark.createDataFrame([("c", "x"), ("d", "x")], "campaign_name string, campaign_objective string")
    new = spark.createDataFrame([("c", "y")], "campaign_name string, campaign_objective string")
    out = joins.latest_metadata(joins.union_sources([("csv", old), ("json", new)]))
    assert sorted(tuple(r) for r in out.select("campaign_name", "campaign_objective", "metadata_source").collect()) == [
        ("c", "y", "json"), ("d", "x", "csv")]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "post_id int")
    issues = quality.required_columns(df, ["post_id", "platform"], "raw", strict=False)
    assert [tuple(r) for r in issues.collect()] == [("raw", "error", "missing_column", "platform")]
    with pytest.raises(ValueError, match="platform"):
        quality.required_columns(df, ["platform"], "raw")
    with pytest.raises(ValueError):
        first_present(df, ["text"], "text")
    with pytest.raises(ValueError):
        quality.assert_leakage_free(["text_content", "likes_count"])


def test_quality_report_counts(spark):
    long = "x" * 40
    df = spark.createDataFrame(
        [("a", 1.0, long), (None, float("nan"), long), ("a", -0.0, None), ("b", 0.0, "y")],
        "name string, engagement_rate double, note string")
    out = {r["column"]: r for r in quality.quality_report(df).collect()}
    assert [out[c]["missing_values"] for c in df.columns] == [1, 1, 1]
    assert [out[c]["unique_values"] for c in df.columns] == [2, 2, 2]
    assert quality.quality_report(df).first()["column"] == "engagement_rate"
    empty = quality.quality_report(df.where("name = 'none'"))
    assert {r["missing_pct"] for r in empty.collect()} == {0.0}


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert tuple(quality.duplicate_rows(df).first()) == (3, 2, 1)


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "post_id int, extra string")
    found = {(r["column"], r["issue"]) for r in schema_drift(spark, df, RAW_POSTS).collect()}
    assert ("post_id", "type") in found and ("extra", "extra") in found and ("platform", "missing") in found


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (1, 4.0), (2, 7.0), (2, None)], "g int, v double")
    out = {r["g"]: (r["q"], r["m"]) for r in ordering.exact_quantiles(
        df, "v", {"q": 0.75, "m": 0.5}, ["g"]).collect()}
    assert out == {1: (3.25, 2.5), 2: (7.0, 7.0)}
    assert ordering.exact_quantiles(df.where("v > 99"), "v", {"m": 0.5}).collect() in ([], [(None,)])


def test_quantiles_and_ranks_over_many_values_with_a_hot_one(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sqrt("id")).alias("v"),
        (F.col("id") % 2).cast("string").alias("g"))
    want = df.agg(F.percentile("v", 0.4).alias("a"), F.percentile("v", 0.95).alias("b")).first()
    got = ordering.exact_quantiles(df, "v", {"a": 0.4, "b": 0.95}).first()
    assert got["a"] == pytest.approx(want["a"], abs=1e-12) and got["b"] == pytest.approx(want["b"], abs=1e-12)
    ladder = ordering.value_ladder(df, "v", "g", ["0", "1"]).cache()
    assert ladder.agg(F.sum("n")).first()[0] == 60_000
    assert ladder.agg(F.sum(F.col("avg_rank") * F.col("n"))).first()[0] == 60_000 * 60_001 / 2
    hot = ladder.where("value = 5.0").first()
    below = df.where("v < 5.0").count()
    assert hot["before"] == below and hot["avg_rank"] == below + (hot["n"] + 1) / 2


def test_published_p_values():
    # Published H, U and p of the platform comparison.
    assert f"{special.chi2_tail(167.3949, 2):.3e}" == "4.474e-37"
    for u, n1, n2, p in ((127805449.5, 15842, 15475, "6.322e-11"), (56713822.5, 15475, 8178, "1.914e-39")):
        z = (abs(u - n1 * n2 / 2) - 0.5) / math.sqrt(n1 * n2 / 12 * (n1 + n2 + 1))
        assert f"{special.normal_two_sided(z):.2e}" == f"{float(p):.2e}"
    assert special.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert special.chi2_tail(7.814727903251179, 3) == pytest.approx(0.05, abs=1e-12)
    assert special.pearson_two_sided(0.576, 12) == pytest.approx(0.05, abs=2e-4)


def test_published_holm_values(spark):
    # Published uncorrected and adjusted p of the three pairs.
    df = spark.createDataFrame(
        [("reddit", "twitter", 6.322e-11), ("reddit", "youtube", 1.798e-12), ("twitter", "youtube", 1.914e-39)],
        "group_a string, group_b string, p_value double")
    out = {(r["group_a"], r["group_b"]): r["p_value_holm"] for r in ranktests.holm(df).collect()}
    assert out[("reddit", "twitter")] == pytest.approx(6.322e-11, rel=1e-3)
    assert out[("reddit", "youtube")] == pytest.approx(3.597e-12, rel=1e-3)
    assert out[("twitter", "youtube")] == pytest.approx(5.741e-39, rel=1e-3)
    capped = ranktests.holm(df.withColumn("p_value", F.lit(0.6)))
    assert set(column(capped, "p_value_holm")) == {1.0}


def test_rank_tests_with_ties_and_an_empty_group(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    u = ranktests.mann_whitney(df, "v", "g", ["a", "b", "none"]).collect()
    assert [(r["group_a"], r["group_b"], r["u_statistic"]) for r in u] == [("a", "b", 1.0)]
    h = ranktests.kruskal_wallis(df, "v", "g", ["a", "b", "none"]).first()
    # Ranks 1 3 3 | 3 5: sums 7 and 8, so H = (12/30 (49/3 + 64/2) - 18) / (1 - 24/120) = 5/3.
    assert h["groups"] == 2 and h["h_statistic"] == pytest.approx(5 / 3, abs=1e-9)


def test_distinctive_terms_without_toxic_rows(spark):
    df = spark.createDataFrame([("x", 0.1, "word word")], "p string, score double, text string")
    assert terms.distinctive_terms(df, "p", ["x"]).count() == 0
    assert terms.toxic_notice(df).first()["aviso"] is not None


def test_predicted_class_absent_from_truth(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b"), ("b", "b")], "t string, p string")
    out = {r["label"]: (r["precision"], r["recall"], r["support"]) for r in
           metrics.class_scores(df, "t", "p").collect()}
    assert out == {"a": (1.0, 0.5, 2), "b": (1.0, 1.0, 2), "c": (0.0, 0.0, 0)}
    matrix = metrics.confusion_matrix(df, "t", "p", ["a", "b", "c"])
    assert [tuple(r)[2:] for r in matrix.orderBy("position").collect()] == [(1, 0, 1), (0, 2, 0), (0, 0, 0)]


def test_one_cluster_agreement(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 0)], "t string, c int")
    row = metrics.cluster_agreement(df, "c", "t").first()
    assert (row["ari"], row["nmi"]) == (0.0, 0.0)
    same = metrics.cluster_agreement(df.withColumn("c", F.ascii("t")), "c", "t").first()
    assert (same["ari"], same["nmi"]) == (1.0, 1.0)


def test_incomplete_truth_gives_agreement_only(spark):
    df = spark.createDataFrame([("a", "a", "a"), (None, "a", "b")], "t string, x string, y string")
    row = metrics.model_benchmark(df, "t", "x", "y").first()
    assert (row["agreement_rate"], row["f1_macro_first"]) == (0.5, None)


def test_split_is_exact_and_independent_of_partitions(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") % 10 == 0, "rare").otherwise("common"))
    first = sampling.stratified_split(df, "id", "c", 0.25)
    counts = {r["c"]: r["n"] for r in first.where("is_test").groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert counts == {"rare": 25, "common": 225}
    again = sampling.stratified_split(df.repartition(3, "id"), "id", "c", 0.25)
    assert first.exceptAll(again).count() == 0
    folds = sampling.folds(df, "id", 3, "c").groupBy("c", "fold").agg(F.count("*").alias("n"))
    assert folds.agg(F.max("n") - F.min("n")).first()[0] is not None
    assert {r["n"] for r in folds.where("c = 'rare'").collect()} <= {33, 34}


def test_split_of_wide_rows_moves_no_texts(spark):
    """The rows of the exact split, with keys and classes shuffled alone; equal keys at a cut are told apart."""
    from tonegauge.learning import tasks

    df = spark.range(1000).withColumn("label", (F.col("id") % 7).cast("double")).withColumn("t", F.lit("text"))
    few = df.union(df.limit(1).selectExpr("id + 2000 AS id", "9D AS label", "t"))
    for share in (0.2, 0.5, 1.0):
        got = sampling.split_rows(few, "id", "label", share).where("is_test").select("id", "label")
        want = sampling.stratified_split(few, "id", "label", share).where("is_test").select("id", "label")
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    train, _ = tasks.split(df, "id")
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()
    same = spark.range(10).select(F.lit(1).alias("id"), F.lit("a").alias("label"))
    assert sampling.split_rows(same, "id", "label").where("is_test").count() == 2


def test_tone_needs_no_labels(spark, tmp_path):
    """Labels that repeat a document neither repeat its text nor move it."""
    from tonegauge.plans import queries_learning

    spark.createDataFrame([(1, "a text", "en", "s"), (2, None, "xx", "s")],
                          "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 2, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    df = queries_learning.tone_posts(spark, str(tmp_path))
    assert sorted(r["post_id"] for r in df.collect()) == [1, 2]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_majority_tie_is_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",)], "c string")
    assert sampling.majority_class(df, "c").first()["prediction"] == "a"


def test_day_without_posts_stays(spark):
    from tonegauge.operators import timing

    df = spark.createDataFrame([("Friday", 1, 2.0)], "dia_semana string, impressions int, engagement_rate double")
    out = timing.day_profile(df).collect()
    assert [r["dia_semana"] for r in out] == K.WEEKDAYS and out[4]["imp_media"] == 1.0 and out[0]["imp_media"] is None


def test_final_table_has_all_columns(spark):
    df = views.posts(spark, "/root/testdata/sf0.001")
    dim = joins.latest_metadata(joins.union_sources([("external_csv", joins.provisional_campaigns(df))]))
    final = etl.stamp(etl.integrate(df, df, dim))
    added = """exists_in_raw_source er_recalc_ev3 log_engagement fake_engagement_flag authentic_success_ev3
        authentic_success_rule text_len word_count hashtag_count mention_count has_question has_exclamation
        campaign_objective target_segment planned_budget_usd priority_level external_source_type
        metadata_source etl_processed_at total_interactions year month hour""".split()
    assert set(final.columns) == set(df.columns) | set(added)
    assert final.count() == df.count()


def test_box_stats_of_one_value(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0)], "g string, v double")
    assert tuple(describe.box_stats(df, "g", "v").first()) == ("a", 2.0, 2.0, 2.0, 2.0, 2.0, 0)


def test_three_digits_round_as_printf_does(spark):
    values = [50.2945, 0.0005, -0.0005, 0.0015, 0.0025, 1.0005, 50.0625, -49.5475, 12.3, -0.0001, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "score_medio double").withColumn("g", F.lit("x"))
    assert column(describe.relative_index(df, "g"), "lectura") == ["x (%.3f)" % v for v in values]
    unknown = spark.createDataFrame([("x", None)], "g string, score_medio double")
    assert column(describe.relative_index(unknown, "g"), "lectura") == [None]
