"""Coercions with the null rules of the data contract.

Bad values become NULL and NaN becomes NULL at the source, so that comparisons,
averages and quantiles downstream never meet NaN (Spark orders NaN above all).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(col: Column | str) -> Column:
    """Number or NULL."""
    value = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_moment(df: DataFrame, name: str) -> Column:
    """Timestamp or NULL; typed timestamps pass through unchanged."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(name)
    return F.try_to_timestamp(F.col(name))


def flag(condition: Column) -> Column:
    """0/1 column in which an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column of a freshly read source."""
    floats = {
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats
        else F.col(f"`{c}`")
        for c in df.columns
    ])


def first_present(df: DataFrame, candidates: list[str], what: str) -> str:
    """The first candidate column the source has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no {what} column among {candidates}; found {df.columns}")
