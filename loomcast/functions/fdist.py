"""Upper tail of the F distribution for whole columns."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_lgamma = np.vectorize(lgamma, otypes=[float])


def regularised_beta(x: np.ndarray, a: np.ndarray, b: np.ndarray, terms: int = 100_000) -> np.ndarray:
    """I_x(a, b) by Lentz's continued fraction, evaluated for all rows at once.

    It ends when no row moves any more; rows that still do after ``terms`` are NaN.
    """
    x, a, b = (np.asarray(v, dtype=float) for v in (x, a, b))
    mirrored = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(mirrored, 1 - x, x), np.where(mirrored, b, a), np.where(mirrored, a, b)
    tiny = 1e-300
    with np.errstate(all="ignore"):
        front = np.exp(
            _lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x)
        ) / a
        c = np.ones_like(x)
        d = 1 / np.where(np.abs(1 - (a + b) * x / (a + 1)) < tiny, tiny, 1 - (a + b) * x / (a + 1))
        fraction, moving = d.copy(), np.zeros(x.shape, bool)
        for m in range(1, terms):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for step in (even, odd):
                d = 1 / np.where(np.abs(1 + step * d) < tiny, tiny, 1 + step * d)
                c = np.where(np.abs(1 + step / c) < tiny, tiny, 1 + step / c)
                fraction = fraction * c * d
            moving = np.abs(c * d - 1) > 4e-16
            if not moving.any():
                break
        value = np.where(moving, np.nan, front * fraction)
    value = np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, value))
    return np.where(mirrored, 1 - value, value)


@F.pandas_udf(T.DoubleType())
def f_upper_tail(statistic: pd.Series, top: pd.Series, bottom: pd.Series) -> pd.Series:
    """P(F > statistic) with ``top`` and ``bottom`` degrees of freedom."""
    f = statistic.to_numpy(float)
    d1, d2 = top.to_numpy(float), bottom.to_numpy(float)
    usable = (f >= 0) & (d1 > 0) & (d2 > 0)  # F may be infinite
    f, d1, d2 = (np.where(usable, v, 1.0) for v in (f, d1, d2))
    tail = regularised_beta(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)
    usable &= ~np.isnan(tail)
    return pd.Series(np.where(usable, tail, np.nan)).astype(object).where(usable, None)
