"""Result tables of the analyses on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loomcast.plans.backtest import Backtest
from loomcast.plans.future import Future
from loomcast.plans.whatif import WhatIf
from loomcast.sources.tables import write_by_series, write_table


def save_panel(master: DataFrame, features: DataFrame, folder: str, grain: str) -> None:
    """Master and feature table, by year, so that temporal cuts read few files."""
    write_table(master, f"{folder}/master_{grain}", partition_by=("year",))
    write_table(features, f"{folder}/feature_{grain}", partition_by=("year",))


def save_backtest(result: Backtest, folder: str, per_series: bool = False) -> None:
    """All forecasts and metrics; with ``per_series`` also a folder per model and series."""
    write_table(result.forecasts, f"{folder}/all_forecasts")
    write_table(result.metrics, f"{folder}/all_metrics")
    if per_series:
        write_by_series(result.metrics, f"{folder}/metrics", "json")
        write_by_series(result.forecasts, f"{folder}/predictions", "csv")


def save_future(result: Future, folder: str) -> None:
    write_table(result.forecasts, f"{folder}/future_forecasts")
    write_table(result.summary, f"{folder}/forecast_summary")


def save_scenarios(result: WhatIf, folder: str) -> None:
    write_table(result.scenarios, f"{folder}/comprehensive_scenarios")
    write_table(result.summary, f"{folder}/scenario_summary")
    write_table(result.impact, f"{folder}/impact_analysis")
