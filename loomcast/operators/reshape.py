"""Header handling, wide-to-long and long-to-wide."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.functions.text import parse_number


def first_of_each_name(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position and keep the first of columns that share a name.

    Works before any column is looked up by name, because Spark cannot resolve
    a name that occurs twice (also when only the case differs).
    """
    slots = [f"_slot_{i}" for i in range(len(names))]
    first: dict[str, tuple[str, str]] = {}
    for slot, name in zip(slots, names):
        first.setdefault(name.lower(), (slot, name))
    return df.toDF(*slots).select([F.col(slot).alias(name) for slot, name in first.values()])


def columns_first(df: DataFrame, leading: Sequence[str]) -> DataFrame:
    """Put the named columns in front and keep the others in their order."""
    lead = [c for c in leading if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def year_columns(df: DataFrame, first: int, last: int) -> list[str]:
    """The columns named after the years from ``first`` to ``last``, as they stand."""
    wanted = {f"{year:04d}" for year in range(first, last + 1)}
    return [name for name in df.columns if name in wanted]


def unpivot_years(df: DataFrame, ids: Sequence[str], name: str, first: int, last: int) -> DataFrame:
    """Wide year columns to rows of (ids, year, measure)."""
    years = year_columns(df, first, last)
    return df.unpivot(list(ids), years, "year", name).withColumn("year", F.col("year").cast("int"))


def clean_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn text columns such as ``'$1,234.5'`` into doubles."""
    return df.withColumns({c: parse_number(F.col(c)) for c in columns})


def literal_rows(rows: Sequence[dict], schema: str) -> Column:
    """A short fixed list of records as an array column, to be exploded."""
    return F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Row union by column name; a column that a frame lacks is null there."""
    if not frames:
        raise ValueError("no table to stack: no model is ranked for any series")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def variables_to_columns(variables: Column, width: int = 5) -> list[Column]:
    """Array of chosen variables as ``exo_var_1 .. exo_var_n`` ('' when absent)."""
    return [
        F.coalesce(F.try_element_at(variables, F.lit(i)), F.lit("")).alias(f"exo_var_{i}")
        for i in range(1, width + 1)
    ]


def columns_to_variables(df: DataFrame, available: Sequence[str], width: int = 5) -> Column:
    """Back from ``exo_var_*`` to an array of names that are non-empty and exist."""
    listed = F.array(*[F.col(f"exo_var_{i}") for i in range(1, width + 1)])
    given = F.filter(listed, lambda v: v.isNotNull() & (v != ""))
    known = F.array(*[F.lit(c) for c in available]) if available else F.array().cast("array<string>")
    return F.array_intersect(given, known)
