"""Registered queries: the streaming jobs over files written from the given tables.

The last window of a stream stays open, because its watermark never passes the end;
a closing row far in the future is appended to the input to flush it.
"""

from pyspark.sql import functions as F

from tonegauge.learning import features as fx
from tonegauge.learning import models as mx
from tonegauge.learning import tasks
from tonegauge.plans import views
from tonegauge.plans.queries_posts import fresh_folder
from tonegauge.plans.registry import query
from tonegauge.plans.views import POSTS, with_views
from tonegauge.streaming import posts as live


def landing(spark, sf, name: str, copies: bool = False):
    """Posts as files in a folder of their own; ``copies`` writes each post twice."""
    df = views.posts(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = fresh_folder(spark, name)
    (df.unionByName(df) if copies else df).write.parquet(path)
    return path, df.schema


def streamed(spark, sf, name: str, copies: bool = False):
    path, schema = landing(spark, sf, name, copies)
    return live.read_stream(spark, path, schema, "parquet")


def finish(spark, df, name: str):
    return live.run_available(df, fresh_folder(spark, name), fresh_folder(spark, name + "-progress"))


@query("t1_stream_ingest", with_views(POSTS) + """
SELECT platform, count(*) AS n, sum(length(text_content))::BIGINT AS chars FROM posts GROUP BY platform""")
def t1(spark, sf):
    valid, _ = live.valid_posts(streamed(spark, sf, "t1"))
    out = finish(spark, valid.select("platform", "text_content"), "t1-out")
    return out.groupBy("platform").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text_content")).alias("chars"))


@query("t1b_stream_rejects", with_views(POSTS) + """
SELECT platform, 'text shorter than 1 character' AS reason, count(*) AS n FROM posts
WHERE CAST(post_id AS BIGINT) % 20 = 0 GROUP BY platform
UNION ALL SELECT platform, 'missing text', count(*) FROM posts
WHERE CAST(post_id AS BIGINT) % 20 = 1 GROUP BY platform""")
def t1b(spark, sf):
    """Every twentieth post loses its text, the next one has none: the reject branch of the stream."""
    at = F.col("post_id").cast("bigint") % 20
    df = views.posts(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn(
        "text_content", F.when(at == 0, "").when(at != 1, F.col("text_content")))
    path = fresh_folder(spark, "t1b")
    df.write.parquet(path)
    _, rejected = live.valid_posts(live.read_stream(spark, path, df.schema, "parquet"))
    out = finish(spark, rejected.select("platform", "reason"), "t1b-out")
    return out.groupBy("platform", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("t2_stream_dedup", with_views(POSTS) + """
SELECT platform, count(*) AS n, count(DISTINCT post_id) AS ids FROM posts GROUP BY platform""")
def t2(spark, sf):
    df = live.with_event_time(streamed(spark, sf, "t2", copies=True), lateness="60 days")
    out = finish(spark, live.drop_repeats(df).select("post_id", "platform"), "t2-out")
    per_id = out.groupBy("platform", "post_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("platform").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids"))


@query("t3_stream_scoring", with_views(POSTS) + """
SELECT count(*) AS scored, count(*) AS same_as_batch FROM posts""")
def t3(spark, sf):
    df, labels = tasks.coded(views.posts(spark, sf), "sentiment_label")
    model = mx.pipeline(fx.text_stages(grams=1), mx.naive_bayes()).fit(df)
    stream = streamed(spark, sf, "t3").select("post_id", "text_content")
    out = finish(spark, live.score_stream(model, stream, labels), "t3-out")
    batch = live.score_stream(model, df.select("post_id", "text_content"), labels)
    both = out.select("post_id", F.col("predicted_label").alias("a")).join(
        batch.select("post_id", F.col("predicted_label").alias("b")), "post_id")
    return both.agg(F.count(F.lit(1)).alias("scored"),
                    F.count(F.when(F.col("a") == F.col("b"), 1)).alias("same_as_batch"))


@query("t4_negative_share_alerts", with_views(POSTS) + """
SELECT strftime(date_trunc('day', "timestamp"), '%Y-%m-%d %H:%M:%S') AS start, platform, count(*) AS posts,
  round(avg(CAST(sentiment_label = 'Negative' AS INTEGER)), 6) AS negative_share
FROM posts GROUP BY 1, 2 HAVING count(*) >= 10 AND avg(CAST(sentiment_label = 'Negative' AS INTEGER)) > 0.45""")
def t4(spark, sf):
    path, schema = landing(spark, sf, "t4")
    closing = spark.createDataFrame(
        [("closing", "none")], "post_id string, platform string").withColumn(
        "timestamp", F.lit("2100-01-01").cast("timestamp"))
    spark.createDataFrame([], schema).unionByName(closing, allowMissingColumns=True).write.mode(
        "append").parquet(path)
    df = live.with_event_time(live.read_stream(spark, path, schema, "parquet"))
    shares = live.negative_share(df, F.col("sentiment_label") == "Negative", window="1 day")
    out = finish(spark, live.alerts(shares, 0.45), "t4-out")
    return out.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "platform", "posts",
        F.round("negative_share", 6).alias("negative_share"))


@query("t4b_sliding_alerts_without_late_rows", with_views(POSTS) + """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, platform, count(*) AS posts,
  round(avg(CAST(sentiment_label = 'Negative' AS INTEGER)), 6) AS negative_share
FROM (SELECT *, unnest([w, w - INTERVAL 12 HOUR]) AS s FROM (
  SELECT *, time_bucket(INTERVAL 12 HOUR, "timestamp", TIMESTAMP '1970-01-01') AS w FROM posts))
GROUP BY 1, 2 HAVING count(*) >= 5 AND avg(CAST(sentiment_label = 'Negative' AS INTEGER)) > 0.45""")
def t4b(spark, sf):
    """Windows of a day every 12 hours; copies of all posts that arrive after the watermark count nowhere."""
    path, schema = landing(spark, sf, "t4b")
    posts = spark.read.schema(schema).parquet(path)
    files = len(posts.inputFiles())
    closing = spark.createDataFrame(
        [("closing", "none")], "post_id string, platform string").withColumn(
        "timestamp", F.lit("2100-01-01").cast("timestamp"))
    spark.createDataFrame([], schema).unionByName(closing, allowMissingColumns=True).coalesce(1).write.mode(
        "append").parquet(path)
    live_rows = live.with_event_time(live.read_stream(spark, path, schema, "parquet", files + 1))
    shares = live.negative_share(
        live_rows, F.col("sentiment_label") == "Negative", window="1 day", slide="12 hours")
    found, out, done = live.alerts(shares, 0.45, 5), fresh_folder(spark, "t4b-out"), fresh_folder(spark, "t4b-progress")
    live.run_available(found, out, done)
    posts.write.mode("append").parquet(path)  # late: the stream goes on where it stopped
    late = live.run_available(found, out, done)
    return late.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "platform", "posts",
        F.round("negative_share", 6).alias("negative_share"))
