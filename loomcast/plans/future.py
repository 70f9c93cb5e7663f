"""Forecasts beyond the history with the best models and their ensemble."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.features import add_history_features
from loomcast.operators.integrate import fill_gaps
from loomcast.operators.models import fit_model, predictions
from loomcast.operators.models.registry import MODELS, PRIORITY
from loomcast.operators.ranking import combine, forecast_summary, rank_models, yearly_summary
from loomcast.operators.reshape import columns_to_variables, stack
from loomcast.operators.selection import without_gaps
from loomcast.operators.split import split_at
from loomcast.plans.backtest import with_fallback
from loomcast.session import checkpoint, together
from loomcast.spec import (
    LAG,
    ROLLING,
    PanelSpec,
    candidates,
    drop_history_features,
    future_candidates,
    matching,
)


@dataclass
class Future:
    forecasts: DataFrame
    summary: DataFrame


def top_models(metrics: DataFrame, spec: PanelSpec, available: Sequence[str], top: int = 3) -> DataFrame:
    """Registry of the best models: keys, model, rank, mape, exo_vars."""
    ranked = rank_models(metrics, spec, top)
    if "exo_var_1" in ranked.columns:
        ranked = ranked.withColumn("exo_vars", columns_to_variables(ranked, available))
    elif "exo_vars" not in ranked.columns:
        ranked = ranked.withColumn("exo_vars", F.lit(None).cast("array<string>"))
    return ranked.select(*spec.keys, "model", "rank", "mape", "exo_vars")


def future_frame(features: DataFrame, spec: PanelSpec, cutoff: int, last: int) -> DataFrame:
    """History and horizon without history features, with ``split``, ``step``, ``t``."""
    plain = drop_history_features(features.dropna(subset=list(spec.keys)))
    return split_at(plain, spec, cutoff, last).withColumn("t", spec.index())


def seeded(
    frame: DataFrame,
    seeds: DataFrame,
    spec: PanelSpec,
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Rebuild lags and means over history followed by seed forecasts.

    ``seeds`` has the cell columns and ``predicted``. The horizon sees real
    history through its lags, and never an actual value of its own periods. A
    series without seeds drops out.
    """
    value = spec.value
    seed = seeds.select(*spec.cell, F.col("predicted").alias("_seed"))
    known = seed.select(*spec.keys).distinct()
    filled = (
        frame.join(known, list(spec.keys), "left_semi")
        .join(seed, list(spec.cell), "left")
        .withColumn(value, F.when(F.col("split") == "train", F.col(value)).otherwise(F.col("_seed")))
        .drop("_seed")
    )
    made = add_history_features(filled, spec, lags, windows, include_current)
    history = matching(made, LAG, ROLLING)
    return fill_gaps(made, spec.keys, spec.time, history)


def seed_forecasts(frame: DataFrame, spec: PanelSpec, **options) -> DataFrame:
    """Smoothing forecasts of the horizon from the observed history."""
    fitted = fit_model("exp_smoothing", frame, spec, **options)
    made = predictions(fitted, frame).filter(F.col("split") == "test")
    return made.filter(F.col("predicted").isNotNull())


def refit(
    frame: DataFrame,
    registry: DataFrame,
    spec: PanelSpec,
    names: Mapping[str, Sequence[str]],
    options: Mapping[str, Mapping] | None = None,
    fallback: bool = False,
) -> DataFrame:
    """Fit each ranked model on the series where it ranks; predict all rows.

    The linear models leave out variables that are not known throughout. With
    ``fallback`` a horizon that a model cannot predict repeats the last value.
    """
    options = options or {}
    ranked = {r.model for r in registry.select("model").distinct().collect()}

    def forecast(model: str) -> DataFrame:
        members = registry.filter(F.col("model") == model)
        rows = frame.join(members.select(*spec.keys), list(spec.keys), "left_semi")
        if model in ("sarimax", "prophet"):
            members = without_gaps(members, rows, spec, names[model])
        fitted = fit_model(model, rows, spec, names.get(model, ()), members, **options.get(model, {}))
        return predictions(fitted, rows)

    listed = [m for m in PRIORITY if m in ranked] + sorted(ranked - set(PRIORITY))
    unknown = [m for m in listed if m not in MODELS]
    if unknown:
        raise ValueError(f"ranked models that cannot be fitted: {unknown}")
    made = together(frame.sparkSession, [partial(forecast, m) for m in listed])
    both = stack(made)
    if fallback:
        both = with_fallback(both, predictions(fit_model("naive", frame, spec), frame), spec)
    both = both.filter(F.col("predicted").isNotNull())
    hidden = F.when(F.col("split") == "train", F.col("actual"))
    return both.withColumn("actual", hidden)


def _assemble(single: DataFrame, joint: DataFrame) -> DataFrame:
    return stack([single, joint.withColumn("status", F.lit("ok"))]).withColumn("in_ensemble", F.lit(True))


def forecast_months(
    features: DataFrame,
    metrics: DataFrame,
    spec: PanelSpec,
    cutoff: int,
    last: int,
    options: Mapping[str, Mapping] | None = None,
) -> Future:
    """Monthly horizon: three best models per series, weighted by inverse MAPE.

    The table has the horizon (no actuals) and the in-sample rows, for the
    models and the ensemble.
    """
    options = options or {}
    frame = checkpoint(future_frame(features, spec, cutoff, last))
    seeds = checkpoint(seed_forecasts(frame, spec, **options.get("exp_smoothing", {})))
    rows = checkpoint(seeded(frame, seeds, spec, include_current=False))
    names = candidates(rows, spec)
    arima_names = candidates(rows, spec, history=False)
    registry = checkpoint(top_models(metrics, spec, names))
    per_model = {m: arima_names if m == "sarimax" else names for m in PRIORITY}
    single = checkpoint(refit(rows, registry, spec, per_model, options))
    joint = combine(single, registry, spec, "inverse_mape", extra=("t", "date", "split", "step"))
    forecasts = _assemble(single, joint)
    return Future(forecasts, forecast_summary(forecasts, spec))


def forecast_years(
    features: DataFrame,
    metrics: DataFrame,
    spec: PanelSpec,
    cutoff: int,
    last: int,
    raw_indicators: tuple[str, ...] = (),
    options: Mapping[str, Mapping] | None = None,
) -> Future:
    """Yearly horizon: three best models per series with equal weights.

    Variables follow a fixed rule instead of the back-test's choice. In-sample
    rows come with the single models, the ensemble covers the horizon.
    """
    options = options or {}
    frame = checkpoint(future_frame(features, spec, cutoff, last))
    seeds = checkpoint(seed_forecasts(frame, spec, **options.get("exp_smoothing", {})))
    rows = checkpoint(seeded(frame, seeds, spec, lags=(1, 2, 3), windows=(2, 3)))
    per_model = {m: future_candidates(rows, m, raw_indicators) for m in PRIORITY}
    registry = checkpoint(_fixed_variables(top_models(metrics, spec, []), per_model))
    wide = {m: {"slots": len(per_model[m]), **options.get(m, {})} for m in ("sarimax", "prophet")}
    single = checkpoint(refit(rows, registry, spec, per_model, {**options, **wide}, fallback=True))
    horizon = single.filter(F.col("split") == "test")
    joint = combine(horizon, registry, spec, extra=("t", "date", "split", "step"))
    return Future(_assemble(single, joint), yearly_summary(horizon, registry, spec))


def _fixed_variables(registry: DataFrame, per_model: Mapping[str, Sequence[str]]) -> DataFrame:
    chosen = F.lit(None).cast("array<string>")
    for model, names in per_model.items():
        listed = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
        chosen = F.when(F.col("model") == model, listed).otherwise(chosen)
    return registry.withColumn("exo_vars", chosen)
