"""Repeatable pseudo-random order of rows, independent of partitioning.

md5 is used so that the same order can be computed outside Spark as well.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(ids: Column, seed: int) -> Column:
    """32 hex digits, uniform over the ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), ids.cast("string")))


def bucket_of(key: Column, digits: int = 3) -> Column:
    """Leading digits of a shuffle key: 16**digits equal buckets in key order."""
    return F.substring(key, 1, digits)


def uniform(key: Column) -> Column:
    """Number in [0, 1) from the leading 12 hex digits (48 bits) of a shuffle key."""
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))
