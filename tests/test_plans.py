"""The plans keep the shape that large tables need."""

import re

import pytest
from pyspark.sql import functions as F

from tonegauge.operators import joins, metrics, ordering, sampling, terms
from tonegauge.plans import views

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def test_first_row_per_key_is_cut_before_the_shuffle(events):
    text = plan(joins.keep_first(events, ["user_id"], [F.col("ts")]))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_best_terms_are_cut_before_the_shuffle(events):
    df = events.select(F.col("event_type").alias("g"), F.col("props").alias("term"), F.col("value").alias("weight"))
    assert re.search(r"WindowGroupLimit .*Partial", plan(terms.top_terms(df, "g")))


def test_order_statistics_shuffle_their_counts_once(events):
    df = ordering.exact_quantiles(events, "value", {"m": 0.5}, ["event_type"])
    df.collect()  # shuffles are reused while the plan runs
    final = plan(df).split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in final
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2


def test_split_shuffles_rows_once(events):
    df = events.select("event_id", "event_type")
    text = plan(sampling.stratified_split(df, "event_id", "event_type"))
    assert "CartesianProduct" not in text and "SinglePartition" not in text


def test_no_query_has_a_cartesian_product(spark):
    import __spark_entry__ as entry

    for name in ("etl_platform_report", "a15_distinctive_terms", "a16_j7_keyword_effect",
                 "a23_mann_whitney", "m1_tfidf_relational"):
        assert "CartesianProduct" not in plan(entry.queries()[name](spark, SF)), name


def test_scan_reads_only_needed_columns(spark):
    text = plan(views.posts(spark, SF).groupBy("platform").agg(F.avg("engagement_rate")))
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_class_counts_do_not_meet_in_one_task(events):
    df = events.select(F.col("user_id").cast("string").alias("label"), F.col("event_type").alias("prediction"))
    assert "Coalesce 1" not in plan(metrics.class_scores(df, "label", "prediction"))


def test_spelling_tables_are_not_broadcast(spark):
    """Their size follows the distinct words, 28 times for the signatures, whatever Spark takes it for."""
    spelling = pytest.importorskip("tonegauge.llm.spelling")
    words = spark.createDataFrame([("harbour", 700), ("harbuur", 130), ("hirbuur", 26)], "word string, n long")
    pairs = spelling.near_pairs(words)
    found = spelling.forms(words, pairs)
    for df in (pairs, found, spelling.roots(found)):
        assert "Broadcast" not in plan(df)
