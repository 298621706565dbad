"""Helpers shared by the operators of this subpackage."""

import math
import string
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonegauge.session import checkpoint_folder

#: ASCII white space; words are the runs of everything else.
SPACE = " \t\n\x0b\x0c\r"
SPACE_REGEX = r"[\x20\x09-\x0D]+"
#: Bytes of rows that go to a Python worker together.
BATCH_BYTES = 8 << 20
LOWER_BYTES = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; Spark's writer creates it."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """For a join: the rows are never broadcast. A table that grows with the input may look small to
    Spark, which goes by the bytes of compressed files and doesn't count what an explode adds."""
    return df.hint("merge")


@contextmanager
def batches_by_bytes(spark: SparkSession, most: int = BATCH_BYTES):
    """Jobs run inside send Python workers about ``most`` bytes at a time, however long the rows are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. A text of one byte per character may use the quicker lower()."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(mapped)


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Words of a text as UTF-8; bytes.split() splits exactly at ASCII white space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(LOWER_BYTES) if lower else raw).split()


def text_blocks(docs: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts make; one narrow pass, grows with the data."""
    total = docs.agg(F.sum(F.octet_length(F.col(text))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return max(1, math.ceil(((total["b"] or 0) + 64 * total["n"]) / block_bytes))
