"""Documents to training sequences: filter, de-duplicate, decontaminate, redact, pack."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.llm import decontamination, ngram_join, packing, pii, quality
from tonegauge.llm.common import scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules take for good stay."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts gives way to its kind; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminate), ("PII", personal_data), ("packing", pack)]

#: Expectation-maximisation and tokenisers are beyond SQL; tests hold a brute-force version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
