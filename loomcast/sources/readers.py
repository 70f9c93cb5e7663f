"""CSV readers. Every column arrives as text and is cleaned by expressions."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.text import parse_number, parse_year, snake_case
from loomcast.operators.reshape import first_of_each_name, unpivot_years


def standardize_headers(df: DataFrame) -> DataFrame:
    """snake_case headers; of columns that then share a name the first stays."""
    return first_of_each_name(df, [snake_case(c) for c in df.columns])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, all columns as text, headers in snake_case."""
    return standardize_headers(spark.read.option("header", True).csv(path))


def read_csv_after_preamble(spark: SparkSession, path: str, preamble: int = 4) -> DataFrame:
    """CSV whose header follows ``preamble`` lines of notes.

    Only the lines up to the header are looked at to learn the column names.
    The file itself is read in splits; the lines before the data are dropped by
    comparing them with those few, so no task has to hold a whole file.
    """
    lines = spark.read.text(path)
    head = [row.value for row in lines.take(preamble + 1)]
    if len(head) <= preamble:
        raise ValueError(f"{path} ends before its header line")
    header = [name or f"unnamed_{i}" for i, name in enumerate(next(csv.reader([head[-1]])))]
    fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))])
    rows = (
        lines.filter(~F.col("value").isin(head) & (F.trim("value") != ""))
        .select(F.from_csv("value", fields.simpleString()[7:-1].replace(":", " ")).alias("r"))
        .select("r.*")
    )
    return first_of_each_name(rows, [snake_case(name) for name in header])


def recode(df: DataFrame, source: str, target: str, codes: Mapping[str, str]) -> DataFrame:
    """Translate codes by a fixed table; a code without an entry becomes null."""
    table = F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])
    return df.withColumn(target, F.try_element_at(table, F.col(source)))


def read_measure(
    spark: SparkSession, path: str, countries: Mapping[str, str], code: str = "country_actual"
) -> DataFrame:
    """Measure table: keeps the raw country code and adds the mapped country."""
    raw = read_text_csv(spark, path).withColumnRenamed("country", code)
    typed = raw.withColumns(
        {
            "year": parse_year(F.col("year")),
            "month": F.col("month").try_cast("int"),
            "value": parse_number(F.col("value")),
        }
    )
    return recode(typed, code, "country", countries)


def unit_in_years(df: DataFrame, unit: str, first: int, last: int) -> DataFrame:
    """Rows of one unit of measure whose year, read from mixed text, is in range."""
    return (
        df.filter(F.col("unit_of_measure") == unit)
        .withColumn("year", parse_year(F.col("year")))
        .filter(F.col("year").between(first, last))
    )


def read_long_indicator(
    spark: SparkSession,
    path: str,
    name: str,
    unit: str,
    first: int = 2011,
    last: int = 2024,
) -> DataFrame:
    """Indicator in long form: one row per area, period and unit of measure."""
    renamed = read_text_csv(spark, path).withColumnsRenamed(
        {"reference_area": "country", "time_period": "year", "obs_value": name}
    )
    return unit_in_years(renamed, unit, first, last).select("country", "year", name)


def read_wide_indicator(
    spark: SparkSession,
    path: str,
    name: str,
    preamble: int = 0,
    first: int = 2011,
    last: int = 2024,
) -> DataFrame:
    """Indicator with one column per year, turned into (country, year, value)."""
    wide = read_csv_after_preamble(spark, path, preamble) if preamble else read_text_csv(spark, path)
    return unpivot_years(wide.withColumnRenamed("country_name", "country"), ["country"], name, first, last)


def read_wide_indicators(
    spark: SparkSession, paths: Mapping[str, str], preamble: int = 4, first: int = 2011, last: int = 2024
) -> dict[str, DataFrame]:
    """Several wide indicators, given as ``{indicator name: path}``."""
    return {
        name: read_wide_indicator(spark, path, name, preamble, first, last)
        for name, path in paths.items()
    }
