"""What-if scenarios: shift a variable, score, compare with the base forecast."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.operators.integrate import scaling_statistics
from loomcast.operators.ranking import spread_columns
from loomcast.operators.reshape import literal_rows
from loomcast.spec import PanelSpec

# The shifts of the three kinds of scenario.
PERCENT_SHIFTS = (-25, -20, -15, -10, -5, 0, 5, 10, 15, 20, 25)
POINT_SHIFTS = (-0.25, -0.20, -0.15, -0.10, -0.05, 0, 0.05, 0.10, 0.15, 0.20, 0.25)
SCALED_SHIFTS = (-0.5, -0.4, -0.3, -0.2, -0.1, 0, 0.1, 0.2, 0.3, 0.4, 0.5)


@dataclass(frozen=True)
class Scenario:
    """One shift of one variable; ``kind`` is 'percent', 'point' or 'scaled'."""

    variable: str
    kind: str
    shift: float

    @property
    def label(self) -> str:
        return f"{self.shift}%" if self.kind == "percent" else f"{self.shift:+} points"


def scenario_list(
    percent: Sequence[str] = (), point: Sequence[str] = (), scaled: Sequence[str] = ()
) -> list[Scenario]:
    """All shifts of the listed variables."""
    kinds = (("percent", percent, PERCENT_SHIFTS), ("point", point, POINT_SHIFTS), ("scaled", scaled, SCALED_SHIFTS))
    return [Scenario(v, kind, s) for kind, names, shifts in kinds for v in names for s in shifts]


def expand(rows: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Repeat every row once per scenario; the list travels inside the plan."""
    listed = [
        {"testing_column": s.variable, "kind": s.kind, "shift": float(s.shift), "scenario": s.label}
        for s in scenarios
    ]
    schema = "testing_column: string, kind: string, shift: double, scenario: string"
    return rows.select("*", F.inline(literal_rows(listed, schema)))


def shifted(variable: str) -> Column:
    """Value of a variable under the scenario of its row."""
    x, by = F.col(variable), F.col("shift")
    moved = F.when(F.col("kind") == "percent", x * (1 + by / 100)).otherwise(x + by)
    return F.when(F.col("testing_column") == variable, moved).otherwise(x)


def apply_shifts(expanded: DataFrame, variables: Sequence[str]) -> DataFrame:
    return expanded.withColumns({v: shifted(v) for v in variables})


def series_statistics(train: DataFrame, spec: PanelSpec, variables: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each variable over the training rows of a series."""
    return train.groupBy(*spec.keys).agg(
        *[F.avg(v).alias(f"{v}_mean") for v in variables],
        *[F.stddev_samp(v).alias(f"{v}_std") for v in variables],
    )


def propagate(shifted_rows: DataFrame, variables: Sequence[str], statistics: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Recompute ``<variable>_norm`` from the shifted variable.

    Models see scaled variables only, so a shift in actual units has to pass
    through the same statistics that scaled the variable: one row for the whole
    panel (``on`` empty), or one row per series.
    """
    known = [v for v in variables if f"{v}_norm" in shifted_rows.columns]
    if on:
        wide = shifted_rows.join(statistics, list(on), "left")
        mean, std = (lambda v: F.col(f"{v}_mean")), (lambda v: F.col(f"{v}_std"))
        spare = [f"{v}_{s}" for v in variables for s in ("mean", "std")]
    else:
        wide = shifted_rows.withColumn("_stats", statistics.select(F.struct("*").alias("s")).scalar())
        mean, std = (lambda v: F.col(f"_stats.{v}_mean")), (lambda v: F.col(f"_stats.{v}_std"))
        spare = ["_stats"]
    renewed = {
        f"{v}_norm": F.when(
            F.col("testing_column") == v, F.try_divide(F.col(v) - mean(v), std(v))
        ).otherwise(F.col(f"{v}_norm"))
        for v in known
    }
    is_known = F.col("testing_column").isin(known) if known else F.lit(False)
    return wide.withColumns(renewed).withColumn("propagated", is_known).drop(*spare)


def panel_statistics(indicators: DataFrame, variables: Sequence[str]) -> DataFrame:
    """The statistics that scaled the indicators in the first place."""
    return scaling_statistics(indicators, variables)


def score_scenarios(
    future: DataFrame,
    spec: PanelSpec,
    scenarios: Sequence[Scenario],
    scorer: Callable[[DataFrame], DataFrame],
    statistics: DataFrame,
    on: Sequence[str] = (),
) -> DataFrame:
    """Base and scenario forecast of every row and scenario.

    ``scorer`` adds ``predicted`` row by row from an already fitted model, so
    nothing is fitted again and the base forecast is the same model's value at
    shift zero. Rows that the model cannot score keep a null forecast.
    """
    variables = sorted({s.variable for s in scenarios})
    raw = [v for v in variables if not v.endswith("_norm")]
    moved = propagate(apply_shifts(expand(future, scenarios), variables), raw, statistics, on)
    row = [*spec.cell, "testing_column", "scenario", "kind", "shift", "propagated"]
    what_if = scorer(moved).select(*row, F.col("predicted").alias("scenario_forecast"))
    base = scorer(future).select(*spec.cell, F.col("predicted").alias("forecast"))
    return what_if.join(base, list(spec.cell), "left")


def flag_influence(scenarios: DataFrame, influential: DataFrame | None, spec: PanelSpec, by: Sequence[str] = ()) -> DataFrame:
    """Mark scenarios of variables that drive the model, also through their scaled twin."""
    if influential is None:
        return scenarios.withColumn("influence_var", F.lit(False))
    variables = F.collect_set(F.regexp_replace("variable", "_norm$", "")).alias("drivers")
    drivers = influential.groupBy(*spec.keys, *by).agg(variables)
    return (
        scenarios.join(drivers, [*spec.keys, *by], "left")
        .withColumn(
            "influence_var",
            F.coalesce(
                F.array_contains("drivers", F.regexp_replace("testing_column", "_norm$", "")), F.lit(False)
            ),
        )
        .drop("drivers")
    )


def scenario_summary(scenarios: DataFrame, spec: PanelSpec) -> DataFrame:
    """Spread of the scenario forecasts over the years, per scenario."""
    return scenarios.groupBy(*spec.keys, "model", "testing_column", "scenario").agg(
        *spread_columns("scenario_forecast")
    )


def impact_analysis(scenarios: DataFrame, spec: PanelSpec) -> DataFrame:
    """Spread of the scenario forecasts over years and shifts, per variable."""
    return scenarios.groupBy(*spec.keys, "model", "testing_column").agg(*spread_columns("scenario_forecast"))
