"""Regression with seasonal ARIMA errors, by greatest likelihood."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.models.base import (
    SLOTS,
    PathModel,
    coefficient_map,
    series_arrays,
    slot_values,
    with_variables,
)
from loomcast.operators.models.statespace import Shape, fitted
from loomcast.spec import PanelSpec

_COLUMNS = ("status", "beta", "weights", "sigma2", "loglik", "n", "path")
_RESULT = "status string, beta array<double>, weights array<double>, sigma2 double, loglik double, n long, path array<double>"
_BATCH = 64  # series filtered together; bounds the memory of one numpy step


def plan_fit(shape: Shape, observations: int, variables: int) -> tuple[str, Shape | None, int]:
    """Status, shape and number of variables that a series of some observations supports.

    The observations beyond those that tell the start levels must outnumber the
    weights. A series too short for a season is fitted without it; the first
    variables enter as far as each leaves another observation.
    """
    for status, tried in (("ok", shape), ("no_season", shape.without_season())):
        spare = observations - tried.lost - tried.weights - 1
        if spare >= 0:
            return ("ok" if not shape.season else status), tried, min(variables, spare)
    return "too_short", None, 0


def arima_solver(shape: Shape, slots: int):
    """Pandas UDF over (periods, training values, variables, number of chosen variables).

    Training periods come first in ``ts``. A period without a row, or whose
    variables are incomplete, is not seen by the filter.
    """

    @F.pandas_udf(_RESULT)
    def run(ts: pd.Series, y: pd.Series, x: pd.Series, chosen: pd.Series) -> pd.DataFrame:
        out = [("too_short", *[None] * (len(_COLUMNS) - 1))] * len(y)
        plans: dict[tuple, list] = {}
        for i, (t, values, regressors, k) in enumerate(zip(ts, y, x, chosen, strict=True)):
            t, values = np.asarray(t, np.int64), np.asarray(values, float)
            table = np.asarray(regressors, float).reshape(len(t), slots)[:, :k]
            known = np.flatnonzero(np.isfinite(table[: len(values)]).all(axis=1))
            if len(known):
                status, own, k = plan_fit(shape, len(known), k)
                if own is not None:
                    plans.setdefault((status, own, k), []).append((i, t - t[known].min(), values, table[:, :k], known))
        for (status, own, k), members in plans.items():
            members.sort(key=lambda m: m[1].max())
            for first in range(0, len(members), _BATCH):
                part = members[first : first + _BATCH]
                size = (len(part), max(int(m[1].max()) for m in part) + 1)
                values, table, seen = np.zeros(size), np.zeros((*size, k)), np.zeros(size, bool)
                for j, (_, at, own_y, own_x, known) in enumerate(part):
                    values[j, at[known]], table[j, at[known]], seen[j, at[known]] = own_y[known], own_x[known], True
                made = fitted(own, values, table, seen)
                for j, (i, at, *_) in enumerate(part):
                    path = np.where(at >= 0, made["path"][j][np.maximum(at, 0)], np.nan)
                    path[at < own.lost] = np.nan  # expected from start levels alone
                    if np.isfinite(made["path"][j]).all():
                        loglik = made["loglik"][j] if made["sigma2"][j] > 0 else None  # without bound where nothing is left
                        out[i] = (status, made["beta"][j], made["weights"][j], made["sigma2"][j], loglik, int(made["n"][j]), path)
                    else:
                        out[i] = ("singular", *[None] * (len(_COLUMNS) - 1))
        return pd.DataFrame(out, columns=list(_COLUMNS))

    return run


def fit_arima(
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = (),
    selection: DataFrame | None = None,
    slots: int = SLOTS,
    order: tuple[int, int, int] = (1, 1, 1),
    seasonal: tuple[int, int, int] = (1, 1, 1),
    name: str = "sarimax",
) -> PathModel:
    """One seasonal ARIMA regression per series, on its chosen variables.

    Exact Gaussian likelihood by a Kalman filter over the calendar; missing
    periods, also inside the training range, are passed over. ``weights`` are
    those of the autoregressive, seasonal autoregressive, moving-average and
    seasonal moving-average terms that the orders ask for. Status: ``ok``,
    ``no_season`` (too short for the seasonal part), ``too_short``, ``singular``.

    The forecast splits into a path of the noise, which no variable touches,
    and a linear effect, so scenarios are scored without another recursion.
    """
    rows = with_variables(frame, spec, selection, slots)
    series = series_arrays(rows, spec, slot_values(names, slots, missing=float("nan")))
    shape = Shape(order, seasonal, spec.season if any(seasonal) else 0)
    chosen = F.least(F.size("exo_vars"), F.lit(slots)) if names else F.lit(0)
    solved = series.withColumn("fit", arima_solver(shape, slots)("ts", "y", "x", chosen)).select(
        *spec.keys,
        "fit.status",
        "fit.weights",
        "fit.sigma2",
        "fit.loglik",
        "fit.n",
        F.map_from_arrays("ts", "fit.path").alias("path"),
        coefficient_map(F.col("fit.beta"), slots).alias("coefficients"),
    )
    return PathModel(name, spec, list(names), solved)
