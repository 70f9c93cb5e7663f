"""Forecast accuracy as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: smallest denominator of the relative error (machine epsilon of a double).
EPSILON = 2.220446049250313e-16


def accuracy_columns(actual: str = "actual", predicted: str = "predicted") -> list[Column]:
    """MAE, MSE, RMSE, MAPE (fraction), MAPE in percent and R2 of paired rows.

    Rows where either side is null do not count. ``mape`` guards a zero actual
    with an epsilon; ``mape_pct`` skips such rows and ``n_zero_actual`` tells
    how many there were.
    """
    paired = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    y = F.when(paired, F.col(actual))
    error = F.when(paired, F.col(actual) - F.col(predicted))
    squared = error * error
    relative = F.abs(error) / F.greatest(F.abs(y), F.lit(EPSILON))
    percent = F.when(y != 0, F.abs(error) / F.abs(y)) * 100
    spread = F.var_pop(y) * F.count(y)
    return [
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(squared).alias("mse"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        F.avg(relative).alias("mape"),
        F.avg(percent).alias("mape_pct"),
        F.count_if(y == 0).alias("n_zero_actual"),
        (1 - F.try_divide(F.sum(squared), spread)).alias("r2"),
    ]
