"""Calendar, lag and rolling features, and the filter on incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomcast.functions.text import finite
from loomcast.spec import CALENDAR, LAG, ROLLING, SCALED, PanelSpec, matching


def add_calendar_features(df: DataFrame) -> DataFrame:
    """Quarter and year-end flag; a yearly panel has neither."""
    if "month" not in df.columns:
        return df
    return df.withColumns(
        {
            "quarter": F.floor((F.col("month") - 1) / 3).cast("int") + 1,
            "is_year_end": (F.col("month") == 12).cast("int"),
        }
    )


def add_history_features(
    df: DataFrame,
    spec: PanelSpec,
    lags: Sequence[int] | None = None,
    windows: Sequence[int] | None = None,
    include_current: bool = True,
    block: int | None = None,
) -> DataFrame:
    """Lags and trailing means of the measure on a dense panel.

    All columns share one partitioning and one order, hence one shuffle and one
    sort. Trailing means skip nulls; with ``include_current=False`` they end one
    period earlier, so that the target is not part of its own feature.

    A series has one row per calendar period. Where that is still too long for
    one task, ``block`` cuts each series into stretches of that many periods:
    the tail of a stretch is repeated at the start of the next one, which keeps
    every lag and mean exact while a single series spreads over many tasks.
    """
    lags = spec.lags if lags is None else lags
    windows = spec.windows if windows is None else windows
    reach = max([0, *lags, *[w if not include_current else w - 1 for w in windows]])
    shift = 0 if include_current else -1
    frame, group = df, list(spec.keys)
    if block is not None:
        frame, group = _overlapping_blocks(df, spec, max(block, reach), reach), [*spec.keys, "_block"]
    ordered = Window.partitionBy(*group).orderBy(*spec.time)
    made = {f"{spec.value}_lag_{k}": F.lag(spec.value, k).over(ordered) for k in lags}
    for w in windows:
        trailing = ordered.rowsBetween(shift - w + 1, shift)
        made[f"{spec.value}_rollmean_{w}"] = F.avg(spec.value).over(trailing)
    out = frame.withColumns(made)
    if block is None:
        return out
    return out.filter(F.col("_block") == F.col("_home")).drop("_block", "_home")


def _overlapping_blocks(df: DataFrame, spec: PanelSpec, size: int, reach: int) -> DataFrame:
    home = F.floor(spec.index() / size)
    near_end = spec.index() % size >= size - reach
    both = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("_home", home).withColumn("_block", F.explode(both))


def model_feature_columns(df: DataFrame) -> list[str]:
    """Columns that must be complete on a row with a measure."""
    wanted = set(matching(df, SCALED, LAG, ROLLING)) | set(CALENDAR)
    return [c for c in df.columns if c in wanted]


def drop_incomplete(df: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """Drop rows that have a measure but a missing or infinite feature.

    Rows without a measure stay: they are the ones to be forecast.
    """
    complete = F.lit(True)
    for c in columns:
        complete = complete & finite(F.col(c).cast("double"))
    return df.filter(F.col(spec.value).isNull() | complete)
