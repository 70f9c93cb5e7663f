"""Back-test: hold out, choose variables, fit, measure, rank, combine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.models import fit_model, predictions
from loomcast.operators.models.registry import PRIORITY
from loomcast.operators.ranking import combine, model_metrics, rank_models
from loomcast.operators.reshape import stack, variables_to_columns
from loomcast.operators.selection import select_variables
from loomcast.operators.split import split_last
from loomcast.session import checkpoint, together
from loomcast.spec import PanelSpec, candidates


@dataclass
class Backtest:
    """``forecasts`` and ``metrics`` cover the models and the ensemble;
    ``selection`` has the chosen variables and ``ranking`` the best models."""

    forecasts: DataFrame
    metrics: DataFrame
    selection: DataFrame
    ranking: DataFrame


def selection_table(
    train: DataFrame,
    spec: PanelSpec,
    names: Sequence[str],
    arima_names: Sequence[str],
    models: Sequence[str],
    importance_rounds: int = 100,
) -> DataFrame:
    """Chosen variables of the models in one table: keys, model, exo_vars."""
    none = train.select(*spec.keys, F.array().cast("array<string>").alias("exo_vars"), F.lit("").alias("model")).limit(0)
    chosen = select_variables(train, spec, names, arima_names, importance_rounds, models)
    return stack([none, *(df.withColumn("model", F.lit(m)) for m, df in chosen.items())])


def with_fallback(forecasts: DataFrame, naive: DataFrame, spec: PanelSpec) -> DataFrame:
    """Where a model has no prediction for a test row, repeat the last value
    and say so in ``status``."""
    backup = naive.filter(F.col("split") == "test").select(*spec.cell, F.col("predicted").alias("_last"))
    missing = F.col("predicted").isNull() & F.col("_last").isNotNull()
    return (
        forecasts.join(backup, list(spec.cell), "left")
        .withColumn("status", F.when(missing, "fallback").otherwise(F.col("status")))
        .withColumn("predicted", F.coalesce("predicted", "_last"))
        .drop("_last")
    )


def backtest(
    features: DataFrame,
    spec: PanelSpec,
    models: Sequence[str] = PRIORITY,
    options: Mapping[str, Mapping] | None = None,
    holdout: int | None = None,
    top: int = 3,
    importance_rounds: int = 100,
    fallback: bool | None = None,
) -> Backtest:
    """Six models on the last observed periods of every series.

    The prepared rows, the chosen variables and the forecasts each feed several
    later steps and are materialised once. ``options`` passes settings to single
    models, e.g. ``{'xgb': {'rounds': 20}}``. With ``fallback`` (the rule for
    yearly panels) a model that fails on a series repeats its last value;
    without, it has no rows there.
    """
    options = options or {}
    fallback = not spec.monthly if fallback is None else fallback
    split = split_last(features.dropna(subset=list(spec.keys)), spec, holdout)
    frame = checkpoint(split.withColumn("t", spec.index()))
    names, arima_names = candidates(frame, spec), candidates(frame, spec, history=False)
    train = frame.filter(F.col("split") == "train")
    selection = checkpoint(
        selection_table(train, spec, names, arima_names, models, importance_rounds)
    )

    def holdout_forecast(model: str) -> DataFrame:
        used = arima_names if model == "sarimax" else names
        chosen = selection.filter(F.col("model") == model)
        fitted = fit_model(model, frame, spec, used, chosen, **options.get(model, {}))
        return predictions(fitted, frame).filter(F.col("split") == "test")

    made = together(frame.sparkSession, [partial(holdout_forecast, m) for m in models])
    both = stack(made)
    if fallback:
        both = with_fallback(both, predictions(fit_model("naive", frame, spec), frame), spec)
    single = checkpoint(both.filter(F.col("predicted").isNotNull()))
    ranking = rank_models(model_metrics(single, spec), spec, top)
    joint = combine(single, ranking, spec, extra=("t", "date", "split", "step"))
    forecasts = stack([single, joint.withColumn("status", F.lit("ok"))])
    metrics = metrics_table(forecasts, selection, spec)
    return Backtest(forecasts, metrics, selection, ranking)


def metrics_table(forecasts: DataFrame, selection: DataFrame, spec: PanelSpec) -> DataFrame:
    """Accuracy per series and model with the variables used and a baseline flag."""
    chosen = selection.select(*spec.keys, "model", "exo_vars")
    return (
        model_metrics(forecasts, spec)
        .join(chosen, [*spec.keys, "model"], "left")
        .select("*", *variables_to_columns(F.col("exo_vars")), (F.col("model") == "exp_smoothing").alias("baseline"))
        .drop("exo_vars")
    )
