"""Data profile: missing values, column description, run statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.session import checkpoint


def missing_report(df: DataFrame, table: str) -> DataFrame:
    """Rows, nulls and share of nulls per column, from one aggregate."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(f.name).alias(f"_{i}") for i, f in enumerate(fields)]
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n"),
            (F.col("n") - F.col(f"_{i}")).alias("nulls"),
            F.try_divide((F.col("n") - F.col(f"_{i}")) * 100.0, F.col("n")).alias("null_pct"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*lines)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, text, x, n): every distinct value of every column, counted.

    Counting combines before the shuffle, so a value that fills a third of the
    table arrives as a handful of rows. Floating-point columns have no ``text``,
    other than numeric columns no ``x``.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for c in columns:
        floating = isinstance(kinds[c], T.FractionalType) and not isinstance(kinds[c], T.DecimalType)
        text = F.lit(None) if floating else F.col(c)
        x = F.col(c) if isinstance(kinds[c], T.NumericType) else F.lit(None)
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"), text.cast("string").alias("text"), x.cast("double").alias("x")
            )
        )
    return (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("text").isNotNull() | F.col("x").isNotNull())
        .groupBy("column_name", "text", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(counts: DataFrame, probabilities: Sequence[float], pieces: int | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation) of counted values per column.

    The distinct values are range-partitioned into pieces of similar size, whose
    totals tell which pieces hold a wanted rank. Only those are ranked, each by
    itself, so no task ever holds or sorts a whole column. The table that is
    broadcast has at most one row per column and piece.
    """
    pieces = pieces or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = counts.filter(F.col("x").isNotNull()).groupBy("column_name", "x").agg(F.sum("n").alias("n"))
    placed = checkpoint(
        numbers.repartitionByRange(pieces, "column_name", "x").withColumn("piece", F.spark_partition_id())
    )
    totals = placed.groupBy("column_name", "piece").agg(F.sum("n").alias("n_piece"))
    before = Window.partitionBy("column_name").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns(
        {
            "skip": F.coalesce(F.sum("n_piece").over(before), F.lit(0)),
            "n_column": F.sum("n_piece").over(Window.partitionBy("column_name")),
        }
    )
    wanted = F.lit(False)
    for p in probabilities:
        position = (F.col("n_column") - 1) * F.lit(float(p))
        for rank in (F.floor(position), F.ceil(position)):
            wanted = wanted | ((F.col("skip") <= rank) & (rank < F.col("skip") + F.col("n_piece")))
    inside = (
        Window.partitionBy("column_name", "piece").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        placed.join(F.broadcast(offsets.filter(wanted)), ["column_name", "piece"]).withColumn(
            "upto", F.col("skip") + F.sum("n").over(inside)
        )
    )

    def at(rank):
        return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("x")))

    picks = []
    for i, p in enumerate(probabilities):
        position = (F.col("n_column") - 1) * F.lit(float(p))
        picks += [
            at(F.floor(position)).alias(f"low{i}"),
            at(F.ceil(position)).alias(f"high{i}"),
            F.max(position - F.floor(position)).alias(f"part{i}"),
        ]
    found = ranked.groupBy("column_name").agg(*picks)
    values = [
        (F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"part{i}")).alias(f"q{i}")
        for i in range(len(probabilities))
    ]
    return found.select("column_name", *values)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value, moments, range and quartiles.

    Everything derives from the counted values, which are materialised because
    four steps read them. The means that are broadcast are one row per column.
    """
    counts = checkpoint(value_counts(df, columns))
    shown = F.coalesce(F.col("text"), F.col("x").cast("string")).alias("text")
    weight = F.col("n").cast("double")
    basics = counts.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("n_unique"),
        F.max(F.struct(F.col("n"), shown)).alias("best"),
        F.max("n").alias("freq"),
        F.sum(F.when(F.col("x").isNotNull(), weight)).alias("w"),
        F.sum(weight * F.col("x")).alias("wx"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    mean = F.try_divide(F.col("wx"), F.col("w"))
    centre = basics.select("column_name", mean.alias("mean"))
    squares = (
        counts.join(F.broadcast(centre), "column_name")
        .groupBy("column_name")
        .agg(F.sum(weight * F.pow(F.col("x") - F.col("mean"), 2)).alias("ss"))
    )
    quarters = quantiles(counts, (0.25, 0.5, 0.75)).toDF("column_name", "q1", "median", "q3")
    return (
        basics.join(squares, "column_name")
        .join(quarters, "column_name", "left")
        .select(
            "column_name",
            "n",
            "n_unique",
            F.col("best.text").alias("top"),
            "freq",
            mean.alias("mean"),
            F.sqrt(F.try_divide(F.col("ss"), F.col("w") - 1)).alias("std"),
            "min",
            "q1",
            "median",
            "q3",
            "max",
        )
    )


def run_statistics(df: DataFrame, spread: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Row count, range of some columns and distinct values of others, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.min(c).alias(f"min_{c}") for c in spread],
        *[F.max(c).alias(f"max_{c}") for c in spread],
        *[F.count_distinct(c).alias(f"n_{c}") for c in distinct],
    )
