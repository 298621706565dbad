"""Live posts: ingest, de-duplication, scoring and alerts on Structured Streaming.

Each function takes and returns a DataFrame, streaming or not, so a batch over the
same rows gives the same result.  State is bounded by the watermark.
"""

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tonegauge.functions.coerce import nan_to_null
from tonegauge.learning.evaluation import score
from tonegauge.operators.quality import split_valid


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "csv",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a landing folder as they arrive, with the batch schema."""
    reader = spark.readStream.format(kind).schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return nan_to_null(reader.load(folder))


def with_event_time(df: DataFrame, column: str = "timestamp", lateness: str = "1 hour") -> DataFrame:
    """Event time as a zoned timestamp, which watermarks require."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def valid_posts(df: DataFrame, text: str = "text_content") -> tuple[DataFrame, DataFrame]:
    """Posts fit for scoring and rejected ones with their reason."""
    return split_valid(df, text)


def drop_repeats(df: DataFrame, key: str = "post_id") -> DataFrame:
    """One row per id within the watermark; state older than that is dropped."""
    return df.dropDuplicatesWithinWatermark([key]) if df.isStreaming else df.dropDuplicates([key])


def score_stream(model: Transformer, df: DataFrame, labels: list[str]) -> DataFrame:
    """Tone label and probabilities of each post."""
    return score(model, df, labels)


def negative_share(
    df: DataFrame, negative: Column, platform: str = "platform", column: str = "timestamp",
    window: str = "1 hour", slide: str | None = None,
) -> DataFrame:
    """T4: posts and share of negative ones per window and platform."""
    span = F.window(column, window, slide) if slide else F.window(column, window)
    return df.groupBy(span.alias("span"), F.col(platform)).agg(
        F.count(F.lit(1)).alias("posts"), F.avg(negative.cast("int")).alias("negative_share"),
    ).select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), platform,
             "posts", "negative_share")


def alerts(shares: DataFrame, threshold: float = 0.5, min_posts: int = 10) -> DataFrame:
    """T4: windows whose negative share exceeds the threshold."""
    return shares.where((F.col("posts") >= min_posts) & (F.col("negative_share") > threshold))


def write_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has arrived into files, exactly once, and stop."""
    return (
        df.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """The rows a finished ``availableNow`` run has written."""
    query = write_available(df, path, checkpoint, mode)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
