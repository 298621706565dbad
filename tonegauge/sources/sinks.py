"""Writers: every task writes its own files, nothing passes through the driver."""

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, drop: bool = True, partition_by: list[str] | None = None) -> None:
    """Load into the store; ``drop`` replaces what is there."""
    writer = df.write.mode("overwrite" if drop else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """UTF-8 with header; quotes are doubled so the file reads back whole."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "encoding", "UTF-8").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report section as JSON records, missing values written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
