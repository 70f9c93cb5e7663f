"""Model names and how each is fitted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.models.arima import fit_arima
from loomcast.operators.models.base import Fitted, PathModel, series_arrays
from loomcast.operators.models.fourier import fit_fourier
from loomcast.operators.models.smoothing import fit_smoothing
from loomcast.operators.models.trees import fit_trees
from loomcast.spec import PanelSpec

# Model names, in the order that breaks ties between equal errors.
PRIORITY = ("sarimax", "exp_smoothing", "prophet", "rf", "xgb", "lgb")


def fit_naive(
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = (),
    selection: DataFrame | None = None,
    name: str = "naive",
) -> PathModel:
    """Last training value, repeated; the fallback of every other model."""
    series = series_arrays(frame, spec)
    last = F.try_element_at(F.col("y"), F.lit(-1))
    parameters = series.select(
        *spec.keys,
        F.when(last.isNull(), "too_short").otherwise("ok").alias("status"),
        F.map_from_arrays("ts", F.transform("ts", lambda _: last)).alias("path"),
        F.create_map().cast("map<string,double>").alias("coefficients"),
    )
    return PathModel(name, spec, [], parameters, baseline=True)


MODELS: dict[str, Callable[..., Fitted]] = {
    "sarimax": fit_arima,
    "exp_smoothing": fit_smoothing,
    "prophet": fit_fourier,
    "rf": partial(fit_trees, kind="rf"),
    "xgb": partial(fit_trees, kind="xgb"),
    "lgb": partial(fit_trees, kind="lgb"),
    "naive": fit_naive,
}


def fit_model(
    model: str,
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str] = (),
    selection: DataFrame | None = None,
    **options,
) -> Fitted | None:
    """Fit a model by name; an unknown name gives none."""
    if model not in MODELS:
        return None
    return MODELS[model](frame, spec, names, selection, **options)
