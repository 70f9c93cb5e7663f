"""Scenario analysis: which variables matter, and what if they moved."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.operators.attribution import influential, mean_absolute, tree_attribution
from loomcast.operators.models import fit_model
from loomcast.operators.models.registry import PRIORITY
from loomcast.operators.models.trees import TreeModel
from loomcast.operators.reshape import stack
from loomcast.operators.scenario import (
    Scenario,
    flag_influence,
    impact_analysis,
    scenario_summary,
    score_scenarios,
)
from loomcast.operators.selection import without_gaps
from loomcast.operators.split import split_at
from loomcast.plans.future import top_models
from loomcast.session import checkpoint, together
from loomcast.spec import SCALED, PanelSpec, matching


@dataclass
class WhatIf:
    scenarios: DataFrame
    summary: DataFrame
    impact: DataFrame


def analyse(
    features: DataFrame,
    metrics: DataFrame,
    spec: PanelSpec,
    cutoff: int,
    last: int,
    scenarios: Sequence[Scenario],
    statistics: DataFrame,
    options: Mapping[str, Mapping] | None = None,
) -> WhatIf:
    """Every scenario for the three best models of each series.

    A model is fitted once on the years before ``cutoff`` and then only scored:
    one pass for the base forecast and one for all scenarios together. Models
    other than smoothing need at least one scaled variable.
    """
    options = options or {}
    split = split_at(features.dropna(subset=list(spec.keys)), spec, cutoff, last)
    frame = checkpoint(split.withColumn("t", spec.index()))
    names = matching(frame, SCALED)
    usable = (F.col("model") == "exp_smoothing") | (F.size("exo_vars") > 0)
    registry = checkpoint(top_models(metrics, spec, names).filter(usable))
    ranked = {r.model for r in registry.select("model").distinct().collect()}

    def what_if(model: str) -> DataFrame:
        members = registry.filter(F.col("model") == model)
        if model in ("sarimax", "prophet"):
            members = without_gaps(members, frame, spec, names, "all")
        rows = frame.join(members.select(*spec.keys), list(spec.keys), "left_semi")
        fitted = fit_model(model, rows, spec, names, members, **options.get(model, {}))
        fitted.parameters = checkpoint(fitted.parameters)
        future = rows.filter(F.col("split") == "test")
        scored = score_scenarios(future, spec, scenarios, fitted.score, statistics)
        drivers = None
        if isinstance(fitted, TreeModel):
            attribution = tree_attribution(fitted, rows).filter(F.col("split") == "test")
            drivers = influential(mean_absolute(attribution, spec), spec)
        flagged = flag_influence(scored, drivers, spec).withColumn("model", F.lit(model))
        return flagged.join(members.select(*spec.keys, "mape"), list(spec.keys))

    made = together(frame.sparkSession, [partial(what_if, m) for m in PRIORITY if m in ranked])
    table = checkpoint(stack(made))
    return WhatIf(table, scenario_summary(table, spec), impact_analysis(table, spec))
