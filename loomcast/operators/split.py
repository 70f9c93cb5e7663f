"""Temporal splits and the last-value forecasts that need nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.spec import PanelSpec


def split_last(df: DataFrame, spec: PanelSpec, periods: int | None = None) -> DataFrame:
    """Hold out the last observed periods of each series.

    Adds ``split`` ('train' or 'test') and ``step``, the number of the test
    period. Unobserved rows are left out, and a series that is no longer than
    the holdout is all test.
    """
    periods = spec.holdout if periods is None else periods
    observed = df.dropna(subset=[spec.value])
    backwards = spec.series().orderBy(*[F.col(c).desc() for c in spec.time])
    n = F.count(F.lit(1)).over(spec.series())
    held = observed.withColumn("_back", F.row_number().over(backwards)).withColumn("_n", n)
    is_test = F.col("_back") <= periods
    step = F.least(F.col("_n"), F.lit(periods)) - F.col("_back") + 1
    return (
        held.withColumn("split", F.when(is_test, "test").otherwise("train"))
        .withColumn("step", F.when(is_test, step).cast("int"))
        .drop("_back", "_n")
    )


def split_at(df: DataFrame, spec: PanelSpec, cutoff: int, last: int | None = None) -> DataFrame:
    """History before year ``cutoff`` as 'train', the years up to ``last`` as 'test'."""
    kept = df if last is None else df.filter(F.col("year") <= last)
    is_test = F.col("year") >= cutoff
    begin = cutoff * 12 if spec.monthly else cutoff
    return kept.withColumn("split", F.when(is_test, "test").otherwise("train")).withColumn(
        "step", F.when(is_test, spec.index() - begin + 1).cast("int")
    )


def last_value_forecast(split: DataFrame, spec: PanelSpec) -> DataFrame:
    """Carry the last training value, and the value one season back, forward.

    ``naive`` repeats the last training value; ``seasonal_naive`` takes the
    latest training value of the same phase of the season. Both are read off
    windows that share one shuffle.
    """
    before = (Window.unboundedPreceding, -1)
    phase = Window.partitionBy(*spec.keys, "_phase").orderBy(*spec.time)
    train_value = F.when(F.col("split") == "train", F.col(spec.value))
    return (
        split.withColumn("_phase", spec.index() % spec.season)
        .withColumn("_past", train_value)
        .withColumn("naive", F.last("_past", ignorenulls=True).over(spec.ordered().rowsBetween(*before)))
        .withColumn("seasonal_naive", F.last("_past", ignorenulls=True).over(phase.rowsBetween(*before)))
        .filter(F.col("split") == "test")
        .drop("_phase", "_past", "split")
    )
