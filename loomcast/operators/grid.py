"""Dense calendar grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.session import checkpoint
from loomcast.spec import PanelSpec


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null values of one or several key columns."""
    return df.select(*columns).dropna().distinct()


def pair_keys(
    left: DataFrame, right: DataFrame, left_parts: int | None = None, right_parts: int = 4
) -> DataFrame:
    """Every combination of two key sets, as an equi-join on a pair of buckets.

    A grid has one row per combination by definition. Both key sets are hashed
    into buckets, and a row visits the buckets of the other side, so that each
    combination meets in exactly one of left x right buckets: the work spreads
    evenly and neither side has to fit into one task.
    """
    left_parts = left_parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def home(df, parts):
        return F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")

    def all_of(parts):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    a = left.withColumn("_l", home(left, left_parts)).withColumn("_r", all_of(right_parts))
    b = right.withColumn("_r", home(right, right_parts)).withColumn("_l", all_of(left_parts))
    return a.join(b, ["_l", "_r"]).drop("_l", "_r")


def add_calendar(keys: DataFrame, first: int, last: int, monthly: bool = True) -> DataFrame:
    """Repeat each key row for every year (and month) of the closed range."""
    yearly = keys.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    if not monthly:
        return yearly
    return yearly.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))


def calendar_grid(
    measures: DataFrame, spec: PanelSpec, first: int, last: int, pairs: str = "all"
) -> DataFrame:
    """Key and calendar columns of a dense panel.

    ``pairs='all'`` combines every product with every country, also where no
    sale was ever seen; ``'observed'`` keeps the combinations that occur.
    """
    if pairs == "observed":
        keys = distinct_keys(measures, *spec.keys)
    else:
        others = [k for k in spec.keys if k != spec.area]
        keys = pair_keys(distinct_keys(measures, *others), distinct_keys(measures, spec.area))
    return add_calendar(keys.select(*spec.keys), first, last, spec.monthly)


def densify(
    measures: DataFrame, spec: PanelSpec, first: int, last: int, pairs: str = "all"
) -> DataFrame:
    """Dense panel: the grid with the measures attached, null where unobserved.

    The measures are read three times (two key sets and the values), so they
    are materialised once; they are an aggregate with one row per cell.
    """
    cells = checkpoint(measures.dropna(subset=list(spec.keys)))
    return attach_measures(cells, spec, first, last, pairs)


def attach_measures(
    cells: DataFrame, spec: PanelSpec, first: int, last: int, pairs: str = "all"
) -> DataFrame:
    """:func:`densify` for measures that are already materialised."""
    grid = calendar_grid(cells, spec, first, last, pairs)
    return grid.join(cells, list(spec.cell), "left")
