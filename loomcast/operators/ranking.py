"""Accuracy per model, ranking, ensembles and forecast summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.accuracy import accuracy_columns
from loomcast.operators.models.registry import PRIORITY
from loomcast.spec import PanelSpec

ENSEMBLE = "ensemble"
# Fixed value: added to the error before it is inverted into a weight.
WEIGHT_OFFSET = 1e-6


def model_metrics(forecasts: DataFrame, spec: PanelSpec) -> DataFrame:
    """Accuracy of every model, the ensemble included, in one aggregate.

    Where the forecasts have a ``status``, the result lists those of a model's
    rows, joined by ``+``.
    """
    made = [F.array_join(F.array_sort(F.collect_set("status")), "+").alias("status")] if "status" in forecasts.columns else []
    return forecasts.groupBy(*spec.keys, "model").agg(*made, *accuracy_columns())


def priority(model: Column) -> Column:
    """Position of a model in the fixed order; unknown names come last."""
    table = F.create_map(*[F.lit(p) for i, name in enumerate(PRIORITY) for p in (name, i)])
    return F.coalesce(F.try_element_at(table, model), F.lit(len(PRIORITY)))


def rank_models(metrics: DataFrame, spec: PanelSpec, top: int = 3) -> DataFrame:
    """Best models per series by MAPE; missing errors last, ties in fixed order.

    A model that only repeated the last value (status ``fallback``) comes after
    all that were fitted.
    """
    fell_back = [F.contains(F.col("status"), F.lit("fallback"))] if "status" in metrics.columns else []
    order = spec.series().orderBy(*fell_back, F.col("mape").asc_nulls_last(), priority(F.col("model")), "model")
    return (
        metrics.filter(F.col("model") != ENSEMBLE)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )


def combine(
    forecasts: DataFrame,
    ranking: DataFrame,
    spec: PanelSpec,
    weights: str = "equal",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Weighted mean of the ranked models, cell by cell.

    Predictions meet on keys and time, never by position, and the weights are
    normalised over the models that have a prediction for that cell.
    ``weights`` is 'equal' or 'inverse_mape'.
    """
    if weights == "inverse_mape":
        weight = 1 / (F.col("mape") + F.lit(WEIGHT_OFFSET))
    else:
        weight = F.lit(1.0)
    members = forecasts.join(ranking.select(*spec.keys, "model", "mape"), [*spec.keys, "model"])
    present = members.filter(F.col("predicted").isNotNull()).withColumn("w", weight)
    return (
        present.groupBy(*spec.cell, *extra)
        .agg(
            F.max("actual").alias("actual"),
            F.try_divide(F.sum(F.col("w") * F.col("predicted")), F.sum("w")).alias("predicted"),
            F.count(F.lit(1)).alias("models_used"),
        )
        .withColumn("model", F.lit(ENSEMBLE))
    )


def side_by_side(forecasts: DataFrame, ranking: DataFrame, spec: PanelSpec, top: int = 3) -> DataFrame:
    """Predictions of the ranked models as ``pred_0 ..``, with their mean."""
    members = forecasts.join(ranking.select(*spec.keys, "model", "rank"), [*spec.keys, "model"])
    return members.groupBy(*spec.cell).agg(
        F.max("actual").alias("actual"),
        *[F.max(F.when(F.col("rank") == i + 1, F.col("predicted"))).alias(f"pred_{i}") for i in range(top)],
        F.avg("predicted").alias("ensemble_pred"),
    )


def spread_columns(value: str) -> list[Column]:
    return [
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def forecast_summary(forecasts: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean, deviation and range of the predictions per series and model."""
    return forecasts.groupBy(*spec.keys, "model").agg(*spread_columns("predicted"))


def yearly_summary(forecasts: DataFrame, ranking: DataFrame, spec: PanelSpec) -> DataFrame:
    """Ensemble value per series and year, and how many models made it."""
    return combine(forecasts, ranking, spec).select(
        *spec.keys, "year", F.col("predicted").alias("forecast"), "models_used"
    )
