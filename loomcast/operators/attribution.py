"""Attribution of predictions to variables by Shapley values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.operators.models.base import Fitted
from loomcast.operators.models.trees import TreeModel
from loomcast.spec import PanelSpec


def tree_attribution(model: TreeModel, rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Shapley value of every model variable for every row that the model can score, in long form.

    Values follow the paths of the trees: what a row's prediction differs from
    the forest's mean over its training rows, dealt out exactly among the
    variables, whatever their number. A variable that the series did not choose
    has zero. Columns: keys, time, split, extra, variable, attribution.
    """
    by = [*model.spec.cell, "split", *extra]
    parts = model.explained(rows).filter(F.col("parts").isNotNull())
    labels = F.array(*[F.lit(n) for n in model.names])
    pairs = F.arrays_zip(labels.alias("variable"), F.col("parts").alias("attribution"))
    return parts.select(*by, F.inline(pairs))


def linear_attribution(
    rows: DataFrame, spec: PanelSpec, coefficients: dict[str, Column], background: DataFrame | None = None
) -> DataFrame:
    """Exact attribution of a linear scorer: coefficient times distance from the
    mean of the variable over the series' training rows."""
    train = F.col("split") == "train"
    by = Window.partitionBy(*spec.keys)
    made = {
        n: weight * (F.col(n) - F.avg(F.when(train, F.col(n))).over(by)) for n, weight in coefficients.items()
    }
    valued = rows.select(*spec.cell, "split", *[c.alias(n) for n, c in made.items()])
    return valued.unpivot([*spec.cell, "split"], list(coefficients), "variable", "attribution")


def mean_absolute(attribution: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mean absolute attribution per series and variable."""
    return attribution.groupBy(*spec.keys, "variable").agg(
        F.avg(F.abs("attribution")).alias("mean_abs_attribution")
    )


def influential(importance: DataFrame, spec: PanelSpec, top: int = 5) -> DataFrame:
    """The variables with the largest mean absolute attribution per series."""
    order = spec.series().orderBy(F.col("mean_abs_attribution").desc_nulls_last(), "variable")
    return importance.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def attribute(model: Fitted, rows: DataFrame) -> DataFrame | None:
    """Attribution of a fitted tree model; other models have none."""
    return tree_attribution(model, rows) if isinstance(model, TreeModel) else None
