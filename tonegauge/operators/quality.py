"""Validation, quality and audit reports."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonegauge.constants import (
    ALLOWED_FEATURES, DROPPED_COLUMNS, FORBIDDEN_FEATURES, LEAKAGE_COLUMNS,
)


def required_columns(df: DataFrame, required: list[str], label: str, strict: bool = True) -> DataFrame:
    """V1: one issue row per missing column; ``strict`` raises instead.  No job."""
    missing = sorted(set(required) - set(df.columns))
    if missing and strict:
        raise ValueError(f"source {label} lacks required columns {missing}")
    return df.sparkSession.createDataFrame(
        [(label, "error", "missing_column", c) for c in missing],
        "source string, severity string, check string, detail string",
    )


def _cell(df: DataFrame, name: str) -> Column:
    """A cell as short text; equal cells give equal text.

    Long text is replaced by its digest, which keeps the shuffle of distinct
    values narrow.  A digest has 33 characters, one more than any raw cell.
    """
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        col = F.when(~F.isnan(col), col + F.lit(0.0))  # NaN is missing, -0.0 is 0.0
    text = col.cast("string")
    if isinstance(kind, T.StringType):
        text = F.when(F.length(text) > 32, F.concat(F.lit("#"), F.md5(text))).otherwise(text)
    return text


def column_profile(df: DataFrame, digits: int = 3) -> DataFrame:
    """V2-V4: dtype, missing count and share, distinct values, leakage flag.

    Cells are unpivoted and counted per (column, value) with map-side partial
    counts; a second grouping on the column adds them up.  The distinct values of
    a column are spread over all tasks instead of being held by one.
    """
    spark = df.sparkSession
    cells = df.select(*[_cell(df, c).alias(c) for c in df.columns]).unpivot(
        [], [f"`{c}`" for c in df.columns], "column", "cell")
    counts = cells.groupBy("column", "cell").agg(F.count(F.lit(1)).alias("_n"))
    sums = counts.groupBy("column").agg(
        F.sum("_n").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("cell").isNull(), F.col("_n"))), F.lit(0))
        .alias("missing_values"),
        F.count("cell").alias("unique_values"),
    )
    facts = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.name in LEAKAGE_COLUMNS)
         for i, f in enumerate(df.schema)],
        "position int, column string, dtype string, leakage_for_prediction boolean",
    )
    missing = F.coalesce("missing_values", F.lit(0).cast("bigint"))
    # One row per column of the schema on both sides.
    return facts.join(F.broadcast(sums), "column", "left").select(
        "position", "column", "dtype", missing.alias("missing_values"),
        F.round(F.coalesce(F.lit(100.0) * F.col("missing_values") / F.col("_rows"), F.lit(0.0)),
                digits).alias("missing_pct"),
        F.coalesce("unique_values", F.lit(0).cast("bigint")).alias("unique_values"),
        "leakage_for_prediction",
    )


def quality_report(df: DataFrame) -> DataFrame:
    """V2/O1: leakage first, then missing share, then column position."""
    return column_profile(df, 3).orderBy(
        F.col("leakage_for_prediction").desc(), F.col("missing_pct").desc(), "position")


def basic_quality(df: DataFrame) -> DataFrame:
    """V3: two digits, most missing first."""
    return column_profile(df, 2).select(
        "position", "column", "dtype", "missing_values", "missing_pct", "unique_values",
    ).orderBy(F.col("missing_pct").desc(), "position")


def column_audit(df: DataFrame) -> DataFrame:
    """V4: column, nulls, type; one narrow aggregate, no distinct counts."""
    nulls = df.agg(*[
        F.count(F.when(_cell(df, c).isNull(), 1)).alias(c) for c in df.columns
    ]).unpivot([], [f"`{c}`" for c in df.columns], "column", "nulls")
    facts = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column string, dtype string")
    return nulls.join(F.broadcast(facts), "column")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """V5: rows, distinct rows and repeats, comparing all columns."""
    whole = df.select(*[_cell(df, c).alias(c) for c in df.columns])
    groups = whole.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def leakage_columns(df: DataFrame) -> DataFrame:
    """V6: leakage columns the table has.  Reads the schema only."""
    return df.sparkSession.createDataFrame(
        [(c,) for c in sorted(set(df.columns) & set(LEAKAGE_COLUMNS))], "column string")


def leakage_audit(df: DataFrame) -> DataFrame:
    """V7: allowed and forbidden features and whether the table has them."""
    rows = [("permitida", c, c in df.columns) for c in ALLOWED_FEATURES]
    rows += [("prohibida_leakage", c, c in df.columns) for c in FORBIDDEN_FEATURES]
    return df.sparkSession.createDataFrame(
        rows, "tipo string, columna string, existe_en_df boolean")


def assert_leakage_free(features: list[str]) -> list[str]:
    """V7: the guard every model of this package runs before fitting."""
    leaked = sorted(set(features) & set(FORBIDDEN_FEATURES))
    if leaked:
        raise ValueError(f"features known only after publishing: {leaked}")
    return features


def dropped_columns(spark: SparkSession) -> DataFrame:
    """V8: catalogue of the columns left out of the tone model."""
    return spark.createDataFrame(list(DROPPED_COLUMNS.items()), "column string, reason string")


def drop_for_tone(df: DataFrame) -> DataFrame:
    return df.drop(*DROPPED_COLUMNS)


def run_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, flag totals in one aggregate."""
    flags = {"fake_engagement_posts": "fake_engagement_flag",
             "authentic_success_ev3_posts": "authentic_success_ev3"}
    sums = [
        (F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)) if c in df.columns
         else F.lit(0).cast("bigint")).alias(out)
        for out, c in flags.items()
    ]
    leaks = sorted(set(df.columns) & set(LEAKAGE_COLUMNS))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *sums).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), *flags,
        F.lit(",".join(leaks)).alias("leakage_columns_flagged"))


def unexpected_codes(df: DataFrame, name: str, known: list) -> DataFrame:
    """Codes outside the map, with their rows."""
    return (
        df.where(F.col(name).isNotNull() & ~F.col(name).isin(known))
        .groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    )


def split_valid(df: DataFrame, name: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring and rejected rows with the reason."""
    reason = F.when(F.col(name).isNull(), "missing text").when(
        F.length(name) < 1, "text shorter than 1 character")
    marked = df.withColumn("reason", reason)
    return (
        marked.where(F.col("reason").isNull()).drop("reason"),
        marked.where(F.col("reason").isNotNull()),
    )
