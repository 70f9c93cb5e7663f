"""Tables between the stages and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Typed intermediate table, metrics table or fitted-parameter table."""
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, form: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """One result table; partition a panel by year so that later cuts prune files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if form == "csv":
        writer = writer.option("header", True)
    writer.format(form).save(path)


def write_by_series(
    df: DataFrame, path: str, form: str = "csv", by: tuple[str, ...] = ("model", "product", "country")
) -> None:
    """One folder per model and series, e.g. metrics as JSON, predictions as CSV.

    Rows of a folder meet in one task before the write, so that each folder
    gets few files; forecasts and metrics have at most a calendar of rows each.
    """
    write_table(df.repartition(*by), path, form, by)
