"""File sources with explicit schemas, and the audits that run before a read."""

from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.functions.coerce import first_present, nan_to_null, to_number
from tonegauge.functions.labels import lookup
from tonegauge.operators.joins import keep_first
from tonegauge.schemas import CAMPAIGNS, RAW_POSTS, all_text

PNG_SIGNATURE = bytes([0x89]) + b"PNG"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = RAW_POSTS,
    label: str | None = None, line_breaks: bool = True,
) -> DataFrame:
    """Header, quotes doubled inside quotes, line breaks inside quotes.

    Files with line breaks in their fields cannot be split, so such sources should
    come as many files; ``line_breaks=False`` lets Spark split files without them.
    Malformed numbers and dates become NULL instead of failing.
    """
    try:
        df = (
            spark.read.schema(schema).option("header", True).option("multiLine", line_breaks)
            .option("escape", '"').option("mode", "PERMISSIVE").csv(path)
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no source {label or ''} at {path}") from error
        raise
    df = nan_to_null(df)
    return df.withColumn("source_loaded_from", F.lit(label)) if label else df


def read_csv_as_text(spark: SparkSession, path: str, schema: T.StructType = RAW_POSTS) -> DataFrame:
    """S1 with every column as text, for sources whose values are coerced later."""
    return read_csv(spark, path, all_text(schema))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = CAMPAIGNS) -> DataFrame:
    """A JSON file holding an array of records."""
    return nan_to_null(spark.read.schema(schema).option("multiLine", True).json(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Can Spark list the path?  No data is read."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first candidate path that exists."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of the candidate sources exists: {candidates}")


def _first_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    def head(uri: str) -> bytes:
        parsed = urlparse(uri)
        if parsed.scheme in ("", "file"):
            system, name = fs.LocalFileSystem(), parsed.path
        else:
            system, name = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(name, compression=None) as stream:
            return stream.read(8)

    for batch in batches:
        heads = [head(uri) for uri in batch["path"]]
        yield pd.DataFrame({
            "path": batch["path"], "length": batch["length"],
            "is_png": [h.startswith(PNG_SIGNATURE) for h in heads],
        })


def audit_signatures(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """S3: files of a landing folder that are images in disguise.

    Only the listing and eight bytes per file are read, never the contents.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(folder).select("path", "length")
    )
    return listing.mapInPandas(_first_bytes, "path string, length bigint, is_png boolean")


TEXT_CANDIDATES = ["text", "comment_text", "tweet", "body", "content"]
SENTIMENT_CANDIDATES = ["sentiment", "sentiment_score", "annotator_sentiment"]
PLATFORM_CANDIDATES = ["platform", "platform_int", "platform_code"]


def toxicity_corpus(df: DataFrame) -> DataFrame:
    """Id, platform and score of the corpus; the scan reads three columns."""
    needed = ["comment_id", "platform", "hate_speech_score"]
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"corpus lacks columns {missing}; it has {sorted(df.columns)}")
    return df.select(needed)


def explain_corpus(df: DataFrame, platforms: dict[int, str]) -> DataFrame:
    """Analysed platforms only, filter and projection evaluated by the scan."""
    text = first_present(df, TEXT_CANDIDATES, "text")
    return (
        df.where(F.col("platform").isin(list(platforms)))
        .select(lookup(F.col("platform"), platforms).alias("platform"),
                to_number("hate_speech_score").alias("score"), F.col(text).alias("text"))
        .na.drop(subset=["platform", "score", "text"])
    )


def correlation_corpus(df: DataFrame, codes: dict[int, str], keep: list[str]) -> DataFrame:
    """Probe the columns, project three, cut codes to integers, drop control text."""
    tone = first_present(df, SENTIMENT_CANDIDATES, "sentiment")
    platform = first_present(df, PLATFORM_CANDIDATES, "platform")
    slim = df.select(
        F.col(tone).cast("double").alias("sentiment"),
        F.col(platform).cast("double").cast("int").alias("platform_code"),
        F.col("hate_speech_score").cast("double").alias("hate_speech_score"),
    ).na.drop()
    return slim.withColumn("platform", lookup(F.col("platform_code"), codes)).where(
        F.col("platform").isin(keep))


CORPUS_COLUMNS = [
    "comment_id", "text", "platform", "hate_speech_score", "sentiment", "respect", "insult",
    "humiliate", "status", "dehumanize", "violence", "genocide", "attack_defend", "hatespeech",
]


def public_corpus(df: DataFrame, dedup_order: str | None = None) -> DataFrame:
    """The wish-list columns that exist, one row per comment if asked."""
    wanted = [c for c in CORPUS_COLUMNS if c in df.columns]
    if dedup_order is None:
        return df.select(wanted)
    kept = keep_first(df.select(*wanted, F.col(dedup_order).alias("_seq")),
                      ["comment_id"], [F.col("_seq").asc()])
    return kept.drop("_seq")


def labelled_benchmark(df: DataFrame, names: dict[int, str], label: str = "label", text: str = "text") -> DataFrame:
    """Integer labels to class names; rows without name or text are left out."""
    return df.withColumn("sentiment_label_real", lookup(F.col(label), names)).na.drop(
        subset=["sentiment_label_real", text])
