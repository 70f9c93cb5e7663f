"""Least squares for many groups at once, from sums of cross products."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cross_products(
    regressors: Sequence[Column], target: Column, usable: Column | None = None
) -> Column:
    """Sums that determine a least-squares fit, as one array of aggregates.

    Layout: count, sums of the regressors and the target, then the upper
    triangle of the products of all of them. Being plain sums they combine on
    the map side, so a group of any size is reduced before the shuffle.
    """
    columns = [*regressors, target]
    firsts = [F.sum(c) for c in columns]
    seconds = [F.sum(a * b) for i, a in enumerate(columns) for b in columns[i:]]
    n = F.count(F.lit(1)) if usable is None else F.count_if(usable)
    return F.array(n.cast("double"), *firsts, *seconds)


def unpack(sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Count, means, centred products of regressors and with the target.

    ``sums`` is groups x sums for ``k`` regressors and one target.
    """
    width = k + 1
    n = sums[:, 0]
    means = sums[:, 1 : 1 + width] / n[:, None]
    products = np.zeros((len(sums), width, width))
    upper = np.triu_indices(width)
    products[:, upper[0], upper[1]] = sums[:, 1 + width :]
    products[:, upper[1], upper[0]] = sums[:, 1 + width :]
    centred = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    return n, means, centred[:, :k, :], centred[:, k, k]


def solve_centred(sums: np.ndarray, k: int, ridge: float) -> np.ndarray:
    """Intercept and coefficients per group; ridge acts on standardised columns.

    A regressor that does not vary inside a group gets coefficient zero, and
    the ridge keeps exact copies of a column solvable.
    """
    n, means, centred, _ = unpack(sums, k)
    spread = np.sqrt(np.maximum(np.einsum("gii->gi", centred[:, :, :k]), 0))
    flat = spread <= 1e-9 * np.sqrt(n[:, None]) * np.maximum(np.abs(means[:, :k]), 1e-300)
    spread = np.where(flat, 1.0, spread)
    keep = ~flat
    corr = centred[:, :, :k] / (spread[:, :, None] * spread[:, None, :])
    corr = corr * keep[:, :, None] * keep[:, None, :]
    diagonal = np.arange(k)
    corr[:, diagonal, diagonal] = 1.0 + ridge
    right = np.where(keep, centred[:, :, k] / spread, 0.0)
    weights = np.linalg.solve(corr, right[:, :, None])[:, :, 0] / spread
    intercept = means[:, k] - (weights * means[:, :k]).sum(axis=1)
    return np.concatenate([intercept[:, None], weights], axis=1)


def solver(k: int, ridge: float):
    """Pandas UDF from the sums of a group to [intercept, coefficients...]."""

    @F.pandas_udf("array<double>")
    def run(sums: pd.Series) -> pd.Series:
        if not len(sums):
            return pd.Series([], dtype=object)
        return pd.Series(list(solve_centred(np.stack(sums.to_numpy()), k, ridge)))

    return run


def fit_groups(
    rows: DataFrame,
    by: Sequence[str],
    regressors: Sequence[Column],
    target: Column,
    ridge: float,
    keep: Sequence[Column] = (),
) -> DataFrame:
    """Least squares of ``target`` on ``regressors`` within each group."""
    sums = rows.groupBy(*by).agg(
        cross_products(regressors, target).alias("sums"), F.count(F.lit(1)).alias("n"), *keep
    )
    return sums.withColumn("beta", solver(len(regressors), ridge)("sums")).drop("sums")
