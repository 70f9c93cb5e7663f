"""What a panel looks like: series keys, time columns, measure, defaults per grain."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAG = re.compile(r"_lag_\d+$")
ROLLING = re.compile(r"_rollmean_\d+$")
SCALED = re.compile(r"_norm$")
CALENDAR = ("quarter", "is_year_end")


@dataclass(frozen=True)
class PanelSpec:
    """Names of the columns of a panel and the defaults of its grain.

    ``keys`` identify a series and ``time`` orders it; every operator takes the
    order from ``time`` and never from the position of a row in a file.
    """

    keys: tuple[str, ...] = ("product", "country")
    area: str = "country"
    time: tuple[str, ...] = ("year", "month")
    value: str = "value"
    season: int = 12
    holdout: int = 12
    lags: tuple[int, ...] = (3, 6, 12)
    windows: tuple[int, ...] = (3, 6, 12)
    causal_lags: int = 3
    causal_min_rows: int = 10

    @property
    def monthly(self) -> bool:
        return "month" in self.time

    @property
    def cell(self) -> tuple[str, ...]:
        """Columns that identify one cell of the panel."""
        return self.keys + self.time

    def index(self) -> Column:
        """Consecutive period number, so that ``index - k`` is k periods back."""
        if self.monthly:
            return F.col("year") * 12 + F.col("month") - 1
        return F.col("year")

    def start_date(self) -> Column:
        """First day of the period."""
        month = F.col("month") if self.monthly else F.lit(1)
        return F.make_date(F.col("year"), month, F.lit(1))

    def series(self) -> Window:
        return Window.partitionBy(*self.keys)

    def ordered(self) -> Window:
        return self.series().orderBy(*self.time)


MONTHLY = PanelSpec()
YEARLY = PanelSpec(
    time=("year",), season=4, holdout=1, lags=(1,), windows=(2,), causal_lags=2, causal_min_rows=5
)


def matching(df: DataFrame, *patterns: re.Pattern) -> list[str]:
    """Column names of ``df``, in order, that match any of the patterns."""
    return [c for c in df.columns if any(p.search(c) for p in patterns)]


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def drop_history_features(df: DataFrame) -> DataFrame:
    """Drop lag and rolling-mean columns before they are computed again."""
    return df.drop(*matching(df, LAG, ROLLING))


def candidates(df: DataFrame, spec: PanelSpec, history: bool = True) -> list[str]:
    """Columns that may enter a model as exogenous variables.

    Monthly panels offer scaled indicators, calendar columns and, with
    ``history``, lags and rolling means. Yearly panels offer every numeric
    column that is not a key, a time column or the measure.
    """
    past = set(matching(df, LAG, ROLLING))
    if spec.monthly:
        wanted = set(matching(df, SCALED)) | {c for c in CALENDAR if c in df.columns} | past
    else:
        wanted = set(numeric(df)) - set(spec.cell) - {spec.value}
    if not history:
        wanted -= past
    return [c for c in df.columns if c in wanted]


def future_candidates(df: DataFrame, model: str, extra: tuple[str, ...] = ()) -> list[str]:
    """Yearly rule for the future horizon: scaled indicators, the named raw
    indicators, and last year's value for every model but the ARIMA one."""
    wanted = set(matching(df, SCALED)) | set(extra)
    if model != "sarimax":
        wanted.add("value_lag_1")
    return [c for c in df.columns if c in wanted]
