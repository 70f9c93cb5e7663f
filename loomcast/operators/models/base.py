"""Shared pieces of the forecast models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.spec import PanelSpec

SLOTS = 5  # variables per model and series, as many as the metrics table has columns for


def default_selection(frame: DataFrame, spec: PanelSpec, names: Sequence[str]) -> DataFrame:
    """The first candidates in column order for every series."""
    first = [F.lit(n) for n in list(names)[:SLOTS]]
    chosen = F.array(*first) if first else F.array().cast("array<string>")
    return frame.select(*spec.keys).distinct().withColumn("exo_vars", chosen)


def with_variables(
    rows: DataFrame, spec: PanelSpec, selection: DataFrame | None, most: int | None = None
) -> DataFrame:
    """Attach each series' chosen variables (``exo_vars``); none when unselected.

    More than ``most`` of them for a series is an error.
    """
    if selection is None:
        return rows.withColumn("exo_vars", F.array().cast("array<string>"))
    chosen = F.col("exo_vars")
    if most is not None:
        too_many = F.raise_error(F.lit(f"more than {most} variables chosen for a series"))
        chosen = F.when(F.size("exo_vars") > most, too_many.cast("array<string>")).otherwise(chosen)
    return rows.join(selection.select(*spec.keys, chosen.alias("exo_vars")), list(spec.keys), "left")


def slot_values(names: Sequence[str], width: int, missing: float | None = 0.0) -> list[Column]:
    """Values of the chosen variables of a row in selection order: 0 beyond the
    choice, ``missing`` where a chosen one has no value."""
    if not names:
        return [F.lit(0.0)] * width
    lookup = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names])
    )
    picked = [F.try_element_at(F.col("exo_vars"), F.lit(i)) for i in range(1, width + 1)]
    return [
        F.when(p.isNull(), 0.0).otherwise(F.coalesce(F.try_element_at(lookup, p), F.lit(missing).cast("double"))) for p in picked
    ]


def variable_effect(coefficients: str, names: Sequence[str]) -> Column:
    """Sum of coefficient times value over the candidates a series uses; null if one has no value."""
    weights = [(n, F.try_element_at(F.col(coefficients), F.lit(n))) for n in names]
    terms = [F.when(w.isNull(), 0.0).otherwise(w * F.col(n).cast("double")) for n, w in weights]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def path_status(level: Column, effect: Column) -> Column:
    """A row's status: the series' own, but where a variable that it needs has no value."""
    return F.when(level.isNotNull() & effect.isNull(), "incomplete").otherwise(F.col("status"))


def coefficient_map(values: Column, width: int) -> Column:
    """``exo_vars`` paired with the first coefficients of an array, as a map."""
    used = F.least(F.size("exo_vars"), F.lit(width), F.size(values))
    return F.map_from_arrays(F.slice("exo_vars", 1, used), F.slice(values, F.lit(1), used))


@dataclass
class Fitted:
    """A fitted model: a parameter table keyed by series, and how to apply it."""

    name: str
    spec: PanelSpec
    names: list[str]
    parameters: DataFrame
    baseline: bool = False

    def score(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError


class PathModel(Fitted):
    """A value per period (``path``) plus a linear effect of variables.

    Parameter table: keys, ``status``, ``path`` map of period to value, and
    ``coefficients`` map of variable to weight.
    """

    def score(self, rows: DataFrame) -> DataFrame:
        kept = self.parameters.select(*self.spec.keys, "status", "path", "coefficients")
        level = F.try_element_at(F.col("path"), F.col("t"))
        effect = variable_effect("coefficients", self.names)
        return (
            rows.join(kept, list(self.spec.keys))
            .withColumns({"predicted": level + effect, "status": path_status(level, effect)})
            .drop("path", "coefficients")
        )


def predictions(fitted: Fitted, frame: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Forecast table of a model on train (in-sample) and test rows."""
    spec = fitted.spec
    scored = fitted.score(frame)
    return scored.select(
        *spec.keys,
        *spec.time,
        "t",
        spec.start_date().alias("date"),
        "split",
        "step",
        *extra,
        F.lit(fitted.name).alias("model"),
        F.col(spec.value).alias("actual"),
        F.when(~F.isnan("predicted"), F.col("predicted")).alias("predicted"),
        "status",
    )


def by_series(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows dealt out by series over all shuffle partitions.

    A series is few bytes and much work, so that partitions joined by their
    size would leave the fits of a panel to few tasks.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *spec.keys)


def series_arrays(frame: DataFrame, spec: PanelSpec, slots: Sequence[Column] = ()) -> DataFrame:
    """One row per series with its cells in time order as arrays.

    Cells are unique per period, so an array is as long as the calendar.
    ``ts`` holds the periods, ``y`` the training values (they come first) and
    ``n_test`` how many periods are to be forecast.
    """
    is_train = F.col("split") == "train"
    rows = frame.filter(~is_train | F.col(spec.value).isNotNull())
    cell = F.struct(
        F.when(is_train, 0).otherwise(1).alias("part"),
        F.col("t"),
        F.col(spec.value).cast("double").alias("y"),
        F.array(*slots).alias("x") if slots else F.array().cast("array<double>").alias("x"),
    )
    kept = ["exo_vars"] if "exo_vars" in rows.columns else []
    return (
        by_series(rows, spec)
        .groupBy(*spec.keys)
        .agg(F.array_sort(F.collect_list(cell)).alias("cells"), *[F.any_value(c).alias(c) for c in kept])
        .select(
            *spec.keys,
            *kept,
            F.transform("cells", lambda c: c["t"]).alias("ts"),
            F.transform(F.filter("cells", lambda c: c["part"] == 0), lambda c: c["y"]).alias("y"),
            F.flatten(F.transform("cells", lambda c: c["x"])).alias("x"),
            F.size(F.filter("cells", lambda c: c["part"] == 1)).alias("n_test"),
        )
    )
