"""From raw measures and indicators to the master and feature tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.operators.features import (
    add_calendar_features,
    add_history_features,
    drop_incomplete,
    model_feature_columns,
)
from loomcast.operators.grid import add_calendar, attach_measures, distinct_keys
from loomcast.operators.integrate import fill_gaps, fold_indicators, roll_up_years, scale, share_of
from loomcast.operators.reshape import clean_numbers, columns_first
from loomcast.session import checkpoint
from loomcast.spec import MONTHLY, YEARLY, PanelSpec, drop_history_features


def indicator_table(
    countries: DataFrame,
    tables: Mapping[str, DataFrame],
    first: int,
    last: int,
    derived: Mapping[str, tuple[str, str]] | None = None,
    unscaled: Sequence[str] = (),
    fit_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Complete and scaled indicators per country and year.

    Only countries of the measure table count. ``derived`` names products such
    as users = percentage / 100 x population. The indicators do not change
    within a year, so they are folded, filled and scaled on yearly rows; giving
    every month its copy would change neither the fills nor the statistics.
    """
    grid = add_calendar(countries, first, last, monthly=False)
    joined = grid.join(fold_indicators(tables), ["country", "year"], "left")
    derived = derived or {}
    wide = joined.withColumns(
        {name: share_of(F.col(percent), F.col(total)) for name, (percent, total) in derived.items()}
    )
    names = [*tables, *derived]
    filled = fill_gaps(wide, ["country"], ["year"], names)
    return scale(filled, [n for n in names if n not in unscaled], fit_range)


def master_monthly(
    measures: DataFrame,
    tables: Mapping[str, DataFrame],
    first: int,
    last: int,
    derived: Mapping[str, tuple[str, str]] | None = None,
    unscaled: Sequence[str] = (),
    fit_range: tuple[int, int] | None = None,
    spec: PanelSpec = MONTHLY,
    pairs: str = "all",
) -> DataFrame:
    """Dense monthly panel with its indicators: keys and measure first."""
    cells = checkpoint(measures.dropna(subset=list(spec.keys)))
    indicators = indicator_table(
        distinct_keys(cells, spec.area), tables, first, last, derived, unscaled, fit_range
    )
    panel = attach_measures(cells, spec, first, last, pairs).join(indicators, [spec.area, "year"], "left")
    return columns_first(panel, [*spec.keys, "country_actual", *spec.time, spec.value])


def master_yearly(
    monthly: DataFrame, spec: PanelSpec = MONTHLY, empty_sum: str = "null"
) -> DataFrame:
    """Yearly panel out of the monthly one."""
    labels = [c for c in ("country_actual",) if c in monthly.columns]
    fixed = {*spec.cell, spec.value, *labels}
    means = [c for c in monthly.columns if c not in fixed]
    return roll_up_years(monthly, spec, means, labels, empty_sum)


def features_monthly(
    master: DataFrame, spec: PanelSpec = MONTHLY, include_current: bool = False
) -> DataFrame:
    """Calendar, lag and rolling features; rows with a measure must be complete."""
    made = add_history_features(add_calendar_features(master), spec, include_current=include_current)
    return drop_incomplete(made, spec, model_feature_columns(made))


def features_yearly(master: DataFrame, spec: PanelSpec = YEARLY) -> DataFrame:
    """Last year's measure; rows with a measure must have it."""
    made = add_history_features(master, spec, lags=(1,), windows=())
    return drop_incomplete(made, spec, [f"{spec.value}_lag_1"])


def yearly_from_monthly(monthly: DataFrame, spec: PanelSpec = MONTHLY, yearly: PanelSpec = YEARLY) -> DataFrame:
    """Yearly training table straight from a monthly one that may hold text.

    Text columns are read as numbers, monthly history features are dropped, and
    the yearly panel gets its own lag and rolling mean.
    """
    labels = {"country_actual"}
    text = [
        f.name
        for f in monthly.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in {*spec.keys, *labels}
    ]
    plain = drop_history_features(clean_numbers(monthly, text))
    return add_history_features(master_yearly(plain.drop(*labels), spec), yearly)
