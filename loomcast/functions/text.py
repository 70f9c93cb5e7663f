"""Cleaning of headers, numbers and years that arrive as text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word begins with capitals or follows what is neither letter nor digit.
_WORDS = r"[A-Z]+[a-z0-9]*|[a-z0-9]+"
# A plain cast would read '12d' as 12.0, so the text must look like a number first.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"


def snake_case(text: str) -> str:
    """Header name in snake_case: ``'Country Name'`` -> ``'country_name'``."""
    return "_".join(re.findall(_WORDS, text)).lower()


def snake_case_column(text: Column) -> Column:
    """The same rule as :func:`snake_case` for a string column."""
    return F.lower(F.array_join(F.regexp_extract_all(text, F.lit(_WORDS), 0), "_"))


def parse_number(text: Column) -> Column:
    """Number out of text such as ``' $1,234.5 '``; anything else becomes null."""
    bare = F.trim(F.regexp_replace(text.cast("string"), r"[$,]", ""))
    sign = F.when(bare.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double")).when(bare.rlike(_INFINITE), sign)


def parse_year(text: Column) -> Column:
    """Year from the first four characters (``'2011-Q1'`` -> 2011), else null."""
    return F.substring(text.cast("string"), 1, 4).try_cast("int")


def finite(number: Column) -> Column:
    """True where a number is neither null, NaN nor infinite."""
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))


def null_if_nan(number: Column) -> Column:
    """Missing values are nulls between operators; NaN is turned at the border."""
    return F.when(~F.isnan(number), number)
