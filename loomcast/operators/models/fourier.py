"""Piecewise-linear trend, Fourier season and regressors."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.models.base import (
    SLOTS,
    Fitted,
    coefficient_map,
    path_status,
    slot_values,
    variable_effect,
    with_variables,
)
from loomcast.operators.models.leastsq import fit_groups
from loomcast.spec import PanelSpec

BREAKS = (0.2, 0.4, 0.6, 0.8)
MIN_ROWS = 3


def shape_columns(season: int, breaks: Sequence[float], order: int) -> list[Column]:
    """Trend, its change points and the season as functions of ``t``.

    ``t_first`` and ``t_last`` bound the training period of the series.
    """
    position = (F.col("t") - F.col("t_first")) / F.greatest(F.col("t_last") - F.col("t_first"), F.lit(1))
    columns = [position]
    columns += [F.greatest(position - F.lit(b), F.lit(0.0)) for b in breaks]
    for k in range(1, order + 1):
        angle = F.col("t") * F.lit(2 * pi * k / season)
        columns += [F.sin(angle), F.cos(angle)]
    return columns


class FourierModel(Fitted):
    """Parameter table: keys, training bounds, ``shape`` weights, ``coefficients``."""

    season: int = 12
    breaks: Sequence[float] = BREAKS
    order: int = 3

    def score(self, rows: DataFrame) -> DataFrame:
        shape = shape_columns(self.season, self.breaks, self.order)
        effect = variable_effect("coefficients", self.names)
        level = F.when(F.col("status") == "ok", F.col("intercept"))
        for i, column in enumerate(shape):
            level = level + F.element_at("shape", i + 1) * column
        kept = self.parameters.select(
            *self.spec.keys, "status", "t_first", "t_last", "intercept", "shape", "coefficients"
        )
        return (
            rows.join(kept, list(self.spec.keys))
            .withColumns({"predicted": level + effect, "status": path_status(level, effect)})
            .drop("t_first", "t_last", "intercept", "shape", "coefficients")
        )


def fit_fourier(
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = (),
    selection: DataFrame | None = None,
    breaks: Sequence[float] = BREAKS,
    order: int | None = None,
    slots: int = SLOTS,
    ridge: float = 1e-3,
    least: int = MIN_ROWS,
    name: str = "prophet",
) -> FourierModel:
    """Trend with change points, smooth season and chosen variables, per series.

    Rows without a value of a chosen variable are not used. All terms are columns, so the fit is one grouped aggregate and a small
    solve per series; one of fewer than ``least`` rows is ``too_short``. Yearly data has no season inside the year.
    """
    if order is None:
        order = 3 if spec.monthly else 0
    train = with_variables(frame, spec, selection, slots).filter(
        (F.col("split") == "train") & F.col(spec.value).isNotNull()
    )
    if names:
        train = train.filter(F.forall(F.array(*slot_values(names, slots, missing=None)), lambda v: v.isNotNull()))
    bounded = train.withColumns(
        {"t_first": F.min("t").over(spec.series()), "t_last": F.max("t").over(spec.series())}
    )
    shape = shape_columns(spec.season, breaks, order)
    terms = {f"_x{i}": c for i, c in enumerate([*shape, *slot_values(names, slots)])}
    fitted = fit_groups(
        bounded.withColumns(terms),
        spec.keys,
        [F.col(c) for c in terms],
        F.col(spec.value),
        ridge,
        keep=[F.any_value(c).alias(c) for c in ("t_first", "t_last", "exo_vars")],
    )
    width = len(shape)
    every = frame.select(*spec.keys).distinct()  # also series without a training row
    parameters = every.join(fitted, list(spec.keys), "left").select(
        *spec.keys,
        F.when(F.col("n") >= least, "ok").otherwise("too_short").alias("status"),
        "n",
        "t_first",
        "t_last",
        F.element_at("beta", 1).alias("intercept"),
        F.slice("beta", 2, width).alias("shape"),
        coefficient_map(F.slice("beta", 2 + width, max(slots, 1)), slots).alias("coefficients"),
    )
    model = FourierModel(name, spec, list(names), parameters)
    model.season, model.breaks, model.order = spec.season, breaks, order
    return model
