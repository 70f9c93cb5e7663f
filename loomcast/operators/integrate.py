"""Indicators: fold, derive, fill, scale; measures: roll up to years."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.operators.reshape import stack
from loomcast.spec import PanelSpec


def fold_indicators(tables: Mapping[str, DataFrame], by: Sequence[str] = ("country", "year")) -> DataFrame:
    """All indicator tables side by side, one row per area and year.

    The tables are stacked in long form and spread again by one aggregation, so
    there is a single shuffle however many tables come in. Repeated rows of an
    area and year are averaged instead of multiplying the panel.
    """
    long = stack(
        [t.select(*by, F.lit(name).alias("variable"), F.col(name).alias("x")) for name, t in tables.items()]
    )
    return long.groupBy(*by).agg(
        *[F.avg(F.when(F.col("variable") == name, F.col("x"))).alias(name) for name in tables]
    )


def repeated_rows(tables: Mapping[str, DataFrame], by: Sequence[str] = ("country", "year")) -> DataFrame:
    """How many rows per table exceed one per area and year."""
    long = stack([t.select(*by, F.lit(name).alias("variable")) for name, t in tables.items()])
    return (
        long.groupBy("variable", *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("variable")
        .agg(F.sum(F.col("n") - 1).alias("repeated"))
    )


def share_of(percent: Column, total: Column) -> Column:
    """A percentage of a total, e.g. internet users out of usage and population."""
    return percent / 100.0 * total


def fill_gaps(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Forward fill, then backward fill, inside each group.

    One sort serves both directions and all columns. A group without any value
    stays null. Groups are areas over a calendar grid, so their size is bounded
    by the calendar.
    """
    ordered = Window.partitionBy(*by).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, 0)
    after = ordered.rowsBetween(0, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after))
        for c in columns
    }
    return df.withColumns(filled)


def scaling_statistics(
    df: DataFrame, columns: Sequence[str], fit_range: tuple[int, int] | None = None
) -> DataFrame:
    """One row with mean and population deviation of each column.

    ``fit_range`` limits the years that count, to keep the forecast period out.
    A constant column gets a divisor of one.
    """
    rows = df if fit_range is None else df.filter(F.col("year").between(*fit_range))
    wanted = []
    for c in columns:
        deviation = F.stddev_pop(c)
        wanted.append(F.avg(c).alias(f"{c}_mean"))
        wanted.append(F.when(deviation == 0, 1.0).otherwise(deviation).alias(f"{c}_std"))
    return rows.agg(*wanted)


def scale(
    df: DataFrame, columns: Sequence[str], fit_range: tuple[int, int] | None = None
) -> DataFrame:
    """Add ``<column>_norm``, the standard score over all areas and periods.

    The statistics enter as a scalar subquery: one row by construction, no
    join, and a plain aggregate that combines before it shuffles.
    """
    one = F.struct("*")
    stats = scaling_statistics(df, columns, fit_range).select(one.alias("s")).scalar()
    scored = df.withColumn("_stats", stats)
    return scored.withColumns(
        {
            f"{c}_norm": (F.col(c) - F.col(f"_stats.{c}_mean")) / F.col(f"_stats.{c}_std")
            for c in columns
        }
    ).drop("_stats")


def roll_up_years(
    panel: DataFrame,
    spec: PanelSpec,
    means: Sequence[str] = (),
    labels: Sequence[str] = (),
    empty_sum: str = "null",
) -> DataFrame:
    """Yearly panel: sum of the measure, mean of the indicators, one label.

    ``empty_sum='zero'`` turns a year without any observation into a real zero;
    ``'null'`` keeps it missing. Rows with a null key belong to no series.
    """
    total = F.sum(spec.value)
    if empty_sum == "zero":
        total = F.coalesce(total, F.lit(0.0))
    return (
        panel.dropna(subset=list(spec.keys))
        .groupBy(*spec.keys, "year")
        .agg(
            total.alias(spec.value),
            *[F.avg(c).alias(c) for c in means],
            *[F.min(c).alias(c) for c in labels],
        )
    )
