"""Tails of distributions for the few result rows of statistical tests.

Two-sided normal tails, chi-square tails of one degree of freedom (normal tails
of the square root) and upper tails of F.  Other tests take fixed critical
values.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Upper 5 % points of chi-square by degrees of freedom, and of
# the limiting Kolmogorov distribution.
CHI2_CRITICAL_05 = {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251179, 4: 9.487729036781154}
KOLMOGOROV_CRITICAL_05 = 1.3580986393225507


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


@F.pandas_udf(DoubleType())
def normal_two_sided_udf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else normal_two_sided(v))


@F.pandas_udf(DoubleType())
def chi2_one_dof_udf(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else math.erfc(math.sqrt(max(v, 0.0) / 2.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated forwards until it settles."""
    tiny = 1e-300
    front, below = 1.0, 1.0 / max(abs(1.0 - (a + b) * x / (a + 1.0)), tiny)
    if 1.0 - (a + b) * x / (a + 1.0) < 0:
        below = -below
    total = below
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            below = 1.0 / ((1.0 + term * below) or tiny)
            front = (1.0 + term / front) or tiny
            total *= below * front
        if abs(below * front - 1.0) < 1e-15:
            break
    return total


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1 - x) / b


def f_upper(f: float, d1: float, d2: float) -> float:
    """Chance of an F variable with (d1, d2) degrees of freedom above ``f``."""
    return 1.0 if f <= 0 else beta_share(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


@F.pandas_udf(DoubleType())
def f_upper_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(b) or b <= 0 else f_upper(x, a, b) for x, a, b in zip(f, d1, d2)], dtype="float64")
