"""Tail probabilities for the few aggregated rows of a significance table."""

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

LARGE_DOF = 1e6


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(abs(1.0 - (a + b) * x / (a + 1.0)), tiny)
    if 1.0 - (a + b) * x / (a + 1.0) < 0:
        d = -d
    h = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * h / a


def student_tails(t: float, dof: float) -> float:
    """Two-sided p of Student's t. In large samples the gamma terms of the beta function cancel, so the normal tail at
    Wallace's corrected value is taken, whose error falls with the square of ``dof``."""
    if dof <= LARGE_DOF:
        return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))
    z = (8 * dof + 1) / (8 * dof + 3) * math.sqrt(dof * math.log1p(t * t / dof))
    return math.erfc(z / math.sqrt(2))


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    return pd.Series([None if pd.isna(x) or pd.isna(v) else student_tails(x, v)
                      for x, v in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal z >= 0, at most 1."""
    return pd.Series([None if pd.isna(x) else min(1.0, math.erfc(x / math.sqrt(2))) for x in z], dtype="float64")
