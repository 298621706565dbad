"""Tail probabilities of the reported tests.

The inputs are test statistics, one per report row, so the Arrow helpers below
run on a handful of rows after the distributed aggregation.
"""

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_tail(x: float, df: int) -> float:
    """P(X > x): finite sums, one for even and one for odd degrees of freedom."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        term = total = math.exp(-half)
        for i in range(1, df // 2):
            term *= half / i
            total += term
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    for i in range(1, (df - 1) // 2 + 1):
        total += math.exp(-half + (i - 0.5) * math.log(half) - math.lgamma(i + 0.5))
    return min(1.0, total)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def pearson_two_sided(r: float, n: float) -> float:
    """Student-t tail of a correlation over n pairs."""
    df = n - 2.0
    if df <= 0:
        return float("nan")
    return beta_regularised(df / 2.0, 0.5, max(0.0, 1.0 - r * r))


def _pairwise(fn, *cols: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*cols)],
        dtype="float64",
    )


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _pairwise(normal_two_sided, z)


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return _pairwise(lambda a, b: chi2_tail(a, int(b)), x, df)


@F.pandas_udf(DoubleType())
def pearson_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return _pairwise(pearson_two_sided, r, n)
