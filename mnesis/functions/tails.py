"""Tails of distributions as vectorised functions; Spark has none of its own."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function I_x(a, b) by its continued fraction (modified Lentz)."""
    tiny = 1e-300
    front = np.exp(np.vectorize(math.lgamma)(a + b) - np.vectorize(math.lgamma)(a) - np.vectorize(math.lgamma)(b) + a * np.log(np.maximum(x, tiny)) + b * np.log1p(-np.minimum(x, 1 - 1e-16)))
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    total = d.copy()
    for m in range(1, 300):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            c = 1 + term / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            total = total * d * c
    return front * total / a


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    direct = x < (a + 1) / (a + b + 2)
    one, two = np.where(direct, a, b), np.where(direct, b, a)
    value = beta_fraction(one, two, np.where(direct, x, 1 - x))
    return np.clip(np.where(direct, value, 1 - value), 0, 1)


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) for Student's t."""
    return incomplete_beta(df / 2, np.full_like(df, 0.5), df / (df + t * t))


def f_upper(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """P(F > f)."""
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def _over(fn, *columns: pd.Series) -> pd.Series:
    arrays = [c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns]
    known = np.all([np.isfinite(a) for a in arrays], axis=0)
    out = np.full(len(columns[0]), np.nan)
    if known.any():
        out[known] = fn(*(a[known] for a in arrays))
    return pd.Series(out).astype("Float64").mask(~known)


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return _over(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _over(f_upper, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def chi2_1_pvalue(x: pd.Series) -> pd.Series:
    """The upper tail of chi-square with one degree of freedom."""
    return _over(lambda v: np.vectorize(lambda y: math.erfc(math.sqrt(max(y, 0) / 2)))(v), x)


@F.pandas_udf(T.DoubleType())
def normal_lower(z: pd.Series) -> pd.Series:
    """P(Z < z) for the standard normal."""
    return _over(lambda v: np.vectorize(lambda y: 0.5 * math.erfc(-y / math.sqrt(2)))(v), z)
