"""Holt-Winters smoothing with additive trend and additive season."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.models.base import PathModel, series_arrays
from loomcast.spec import PanelSpec

GRID = tuple(product((0.1, 0.3, 0.5, 0.7, 0.9), (0.01, 0.1, 0.3), (0.01, 0.1, 0.3, 0.5)))
_RESULT = "status string, alpha double, beta double, gamma double, sse double, path array<double>"
_BATCH = 256  # series smoothed together; bounds the memory of one numpy step


def has_season(y: np.ndarray, m: int) -> bool:
    """Whether a calendar of values (nan where there is none) tells a season: two of them, with a value in each."""
    return len(y) >= 2 * m and bool(np.isfinite(y[m : 2 * m]).any())


def smooth(y: np.ndarray, steps: int, grid: np.ndarray, m: int) -> dict[str, np.ndarray]:
    """Smooth equally long series with every parameter set and keep the best.

    ``y`` is series x period from each series' first value on, nan where a period
    has none, ``grid`` is parameter sets x 3, and ``m`` the season, or 1 for none.
    The recursion runs over time once, for all series and parameter sets
    together. A period without a value moves level and season on and counts
    no error. Without a season the first two values give level and trend.
    """
    count, n = y.shape
    a, b, g = (grid[:, i][None, :] for i in range(3))
    shape = (count, len(grid))
    if m > 1:
        first, second = np.nanmean(y[:, :m], axis=1), np.nanmean(y[:, m : 2 * m], axis=1)
        slope = (second - first) / m
        level0 = first + slope * (m - 1) / 2
        season0 = np.nan_to_num(y[:, :m] - (first[:, None] + slope[:, None] * (np.arange(m) - (m - 1) / 2)))
        start, begun = m, np.ones(count, bool)
    else:
        slope, level0, season0, start, begun = np.zeros(count), y[:, 0], np.zeros((count, 1)), 1, np.zeros(count, bool)
    level = np.broadcast_to(level0[:, None], shape)
    trend = np.broadcast_to(slope[:, None], shape)
    season = [np.broadcast_to(season0[:, i][:, None], shape) for i in range(m)]
    sse, fitted = np.zeros(shape), []
    for i in range(start, n):
        seen = np.isfinite(y[:, i])
        second, seen = (seen & ~begun)[:, None], (seen & begun)[:, None]
        x, s = np.nan_to_num(y[:, i])[:, None], season[i % m]
        fitted.append(np.where(begun[:, None], level + trend + s, np.nan))
        error = np.where(seen, x - (level + trend + s), 0.0)
        sse = sse + error * error
        new_level = np.where(seen, a * (x - s) + (1 - a) * (level + trend), level + trend)
        if m > 1:
            season[i % m] = np.where(seen, g * (x - level - trend) + (1 - g) * s, s)
        trend = np.where(seen, b * (new_level - level) + (1 - b) * trend, trend)
        trend = np.where(second, (x - y[:, :1]) / i, trend)
        level = np.where(second, x, new_level)
        begun = begun | second[:, 0]
    best = sse.argmin(axis=1)
    rows = np.arange(count)
    ahead = [
        (level + (h + 1) * trend + season[(n + h) % m])[rows, best] for h in range(steps)
    ]
    inside = [np.full(count, np.nan)] * start + [f[rows, best] for f in fitted]
    return {"best": best, "sse": sse[rows, best], "path": np.stack(inside + ahead, axis=1)}


def smoother(grid: Sequence[tuple[float, float, float]], season: int):
    """Pandas UDF over (periods, training values); training periods come first."""
    table = np.asarray(grid, dtype=float)

    @F.pandas_udf(_RESULT)
    def run(ts: pd.Series, y: pd.Series) -> pd.DataFrame:
        out = [("too_short", None, None, None, None, None)] * len(y)
        groups: dict[tuple, list] = {}
        for i, (t, values) in enumerate(zip(ts, y, strict=True)):
            t, values = np.asarray(t, np.int64), np.asarray(values, float)
            if len(values) < 2:
                continue
            at = t - t[0]
            calendar = np.full(at[len(values) - 1] + 1, np.nan)
            calendar[at[: len(values)]] = values
            groups.setdefault((len(calendar), has_season(calendar, season)), []).append((i, at, calendar))
        for (n, seasonal), members in groups.items():
            for first in range(0, len(members), _BATCH):
                part = members[first : first + _BATCH]
                steps = max(0, max(int(at[-1]) for _, at, _ in part) + 1 - n)
                found = smooth(np.stack([c for *_, c in part]), steps, table, season if seasonal else 1)
                for k, (i, at, _) in enumerate(part):
                    out[i] = ("ok" if seasonal else "no_season", *table[found["best"][k]], found["sse"][k], found["path"][k][at])
        return pd.DataFrame(out, columns=["status", "alpha", "beta", "gamma", "sse", "path"])

    return run


def fit_smoothing(
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = (),
    selection: DataFrame | None = None,
    grid: Sequence[tuple[float, float, float]] = GRID,
    name: str = "exp_smoothing",
) -> PathModel:
    """Holt-Winters per series; smoothing weights by least squared error on a grid.

    States follow the calendar: a missing period, also one before the horizon,
    moves them on. Needs two full seasons with a value in each; shorter series
    are smoothed without a season, and a series with a single value gets no
    forecast. Exogenous variables play no
    part, which makes this the baseline and the source of seed forecasts.
    """
    series = series_arrays(frame, spec)
    fitted = series.withColumn("fit", smoother(grid, spec.season)("ts", "y")).select(
        *spec.keys,
        "fit.status",
        "fit.alpha",
        "fit.beta",
        "fit.gamma",
        "fit.sse",
        F.map_from_arrays("ts", "fit.path").alias("path"),
        F.create_map().cast("map<string,double>").alias("coefficients"),
    )
    return PathModel(name, spec, [], fitted, baseline=True)
