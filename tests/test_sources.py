"""Readers, writers, the whole posts job and the streams on scratch folders."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from tonegauge.plans import etl, toxicity, views
from tonegauge.schemas import CAMPAIGNS, COMMENTS, LABELLED_TEXT, RAW_POSTS
from tonegauge.sources import collections, files, sinks
from tonegauge.sources.sqlite import read_sqlite
from tonegauge.streaming import posts as live

SF = "/root/testdata/sf0.001"


def raw_posts(spark):
    return views.posts(spark, SF).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    rows = [('say "hi",\nall', "Neutral"), ("plain", "Positive")]
    path = str(tmp_path / "t")
    sinks.write_csv(spark.createDataFrame(rows, LABELLED_TEXT), path)
    got = files.read_csv(spark, path, LABELLED_TEXT, "sample").collect()
    assert sorted(tuple(r) for r in got) == sorted((t, l, "sample") for t, l in rows)


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="raw"):
        files.read_csv(spark, str(tmp_path / "none.csv"), label="raw").count()
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [str(tmp_path / "none.csv")])


def test_image_named_csv_is_found(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(bytes([0x89]) + b"PNG\r\n\x1a\nrest")
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "c.txt").write_text("x")
    found = {r["path"].split("/")[-1]: r["is_png"]
             for r in files.audit_signatures(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": True, "b.csv": False}


def test_sqlite_table_in_ranges(spark, tmp_path):
    path = str(tmp_path / "meta.sqlite")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE campaign_metadata (campaign_name TEXT, planned_budget_usd INTEGER, share REAL)")
        db.executemany("INSERT INTO campaign_metadata VALUES (?, ?, ?)",
                       [(f"C{i}", i, i / 2) for i in range(50)] + [("none", None, None)])
        db.execute("DELETE FROM campaign_metadata WHERE planned_budget_usd BETWEEN 10 AND 19")
    df = read_sqlite(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "bigint", "double"]
    assert df.count() == 41 and df.agg(F.sum("planned_budget_usd")).first()[0] == sum(range(50)) - sum(range(10, 20))


def test_collection_export(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text("\n".join(json.dumps({"_id": i, "text": f"t{i}"}) for i in range(3)))
    df = collections.read_collection(spark, "c", export=str(path))
    assert df.columns == ["text", "metadata_source"] and df.count() == 3
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError, match="empty"):
        collections.read_collection(spark, "c", export=str(tmp_path / "empty.json"), schema=LABELLED_TEXT)


def test_posts_job_end_to_end(spark, tmp_path):
    base = raw_posts(spark)
    sinks.write_csv(base, str(tmp_path / "raw"))
    sinks.write_csv(base.withColumn("er_segment", F.lit("low")), str(tmp_path / "extra"))
    from tonegauge.schemas import ENRICHED_POSTS

    wide = base.select(*base.columns, *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in ENRICHED_POSTS if f.name not in base.columns])
    sinks.write_csv(wide, str(tmp_path / "enriched"))
    (tmp_path / "api.json").write_text(json.dumps([{"campaign_name": "C3", "campaign_objective": "relaunch"}]))
    job = etl.PostsJob(
        raw=str(tmp_path / "raw"), enriched=str(tmp_path / "enriched"),
        campaigns_csv=str(tmp_path / "campaigns"), output=str(tmp_path / "out"),
        campaigns_json=str(tmp_path / "api.json"), campaigns_sqlite=str(tmp_path / "none.sqlite"))
    final = job.run(spark)
    assert final.count() == base.count() and len(final.columns) == 60
    assert {r[0] for r in final.where("campaign_name = 'C3'").select("metadata_source").distinct().collect()} == {"api_json"}
    assert files.read_csv(spark, str(tmp_path / "campaigns"), CAMPAIGNS).count() == 23
    summary = spark.read.json(str(tmp_path / "out" / "summary")).first()
    assert summary["n_rows"] == base.count() and summary["fake_engagement_posts"] > 0
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "quality_report")).count() == 60


def test_toxicity_reports(spark, tmp_path):
    corpus = views.comments(spark, "/root/testdata/sf0.01")
    comments = toxicity.analysed_comments(corpus, "annotator")
    sections = toxicity.platform_benchmark(comments)
    assert {r["platform_name"] for r in sections["descriptive"].collect()} == {"reddit", "twitter", "youtube"}
    assert sections["pairwise"].count() == 3
    explained = toxicity.explain(corpus)
    toxicity.write_sections({k: explained[k] for k in ("threshold", "tail")}, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "threshold")).count() == 3


def test_filters_and_columns_reach_the_scan(spark):
    text = spark.read.parquet(f"{SF}/events.parquet").where(
        F.col("event_type").isin("click")).select("value")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_stream_equals_batch(spark, tmp_path):
    df = raw_posts(spark)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = live.read_stream(spark, str(tmp_path / "in"), df.schema, "parquet", files_per_batch=1)
    unique = live.drop_repeats(live.with_event_time(stream, lateness="60 days"))
    out = live.run_available(unique.select("post_id", "platform"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert out.count() == df.count() and out.exceptAll(df.select("post_id", "platform")).count() == 0


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "platform string, sentiment_label string, timestamp timestamp"

    def land(name, stamps):
        rows = [("x", "Negative", s) for s in stamps]
        spark.createDataFrame(rows, "platform string, sentiment_label string, timestamp string").select(
            "platform", "sentiment_label", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))

    kind = spark.createDataFrame([], schema).schema
    shares = lambda: live.negative_share(
        live.with_event_time(live.read_stream(spark, str(tmp_path / "in"), kind, "parquet")),
        F.col("sentiment_label") == "Negative")
    for stamps in (["2024-01-01 00:10:00"], ["2024-01-01 05:00:00"], ["2024-01-01 00:20:00"],
                   ["2024-01-02 00:00:00"]):
        land("in", stamps)
        out = live.run_available(shares(), str(tmp_path / "out"), str(tmp_path / "cp"))
    first = out.where("start = '2024-01-01 00:00:00'").collect()
    assert [r["posts"] for r in first] == [1]


def test_comment_schema_matches_contract():
    assert "hate_speech_score" in COMMENTS.names and len(RAW_POSTS) == 28
