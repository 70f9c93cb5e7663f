"""Choice of exogenous variables per series, at most five per model."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomcast.functions.fdist import f_upper_tail
from loomcast.operators.models.leastsq import cross_products, unpack
from loomcast.operators.models.trees import regressor, training_series
from loomcast.spec import PanelSpec

TOP = 5


def long_form(train: DataFrame, spec: PanelSpec, names: Sequence[str]) -> DataFrame:
    """One row per cell and candidate: keys, time, ``y``, ``variable``,
    ``ordinal`` (column order) and ``x``."""
    entries = [
        F.struct(
            F.lit(n).alias("variable"), F.lit(i + 1).alias("ordinal"), F.col(n).cast("double").alias("x")
        )
        for i, n in enumerate(names)
    ]
    return train.select(
        *spec.keys, *spec.time, F.col(spec.value).alias("y"), F.inline(F.array(*entries))
    )


def varying(long: DataFrame, spec: PanelSpec) -> DataFrame:
    """Candidates with more than one distinct value in a series.

    Smallest and largest value answer that without counting distinct values.
    """
    return (
        long.groupBy(*spec.keys, "variable", "ordinal")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .filter(F.col("low") < F.col("high"))
        .drop("low", "high")
    )


def mutual_information(long: DataFrame, spec: PanelSpec, bins: int = 4) -> DataFrame:
    """Mutual information of each candidate with the measure, from equal-count bins.

    Missing values count as zero. Ties fall into bins in time order, so the
    score is reproducible.
    """
    by = [*spec.keys, "variable"]
    filled = long.withColumn("x", F.coalesce("x", F.lit(0.0)))
    binned = filled.withColumns(
        {
            "bx": F.ntile(bins).over(Window.partitionBy(*by).orderBy("x", *spec.time)),
            "by": F.ntile(bins).over(Window.partitionBy(*by).orderBy("y", *spec.time)),
        }
    )
    cells = binned.groupBy(*by, "ordinal", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    n_x = F.sum("n").over(Window.partitionBy(*by, "bx"))
    n_y = F.sum("n").over(Window.partitionBy(*by, "by"))
    term = F.col("n") / F.col("total") * F.log(F.col("n") * F.col("total") / (F.col("n_x") * F.col("n_y")))
    return (
        cells.withColumns({"total": total, "n_x": n_x, "n_y": n_y})
        .groupBy(*by, "ordinal")
        .agg(F.sum(term).alias("score"))
    )


#: Share of a sum of squares, or of a standardised one, that counts as none.
EXACT_FIT = 1e-12
RESIDUALS = T.StructType(
    [T.StructField("rss_without", T.DoubleType()), T.StructField("rss_with", T.DoubleType())]
)


@F.pandas_udf(RESIDUALS)
def residual_sums(sums: pd.Series, lags: pd.Series) -> pd.DataFrame:
    """Residual sums of squares without and with the candidate's lags."""
    out = pd.DataFrame(np.nan, index=range(len(sums)), columns=["rss_without", "rss_with"])
    for n_lags, rows in pd.Series(range(len(lags))).groupby(lags.to_numpy()):
        _, _, centred, yy = unpack(np.stack(sums.iloc[rows].to_numpy()), 2 * n_lags)
        for label, width in (("rss_without", n_lags), ("rss_with", 2 * n_lags)):
            xx, xy = centred[:, :width, :width], centred[:, :width, -1]
            weights = np.einsum("gij,gj->gi", np.linalg.pinv(xx, rcond=1e-12, hermitian=True), xy)
            out.loc[rows, label] = np.maximum(yy - (weights * xy).sum(axis=1), 0.0)
    return out


def causality_tests(long: DataFrame, spec: PanelSpec, max_lag: int | None = None) -> DataFrame:
    """Granger test of every candidate for each lag length.

    For ``lags`` = 1..max_lag the measure is regressed on its own lags, and on
    its own and the candidate's lags; the F statistic compares the two. Both
    fits come from the same sums of cross products, so a series of any length
    reaches the solve as one small row. Columns: keys, variable, ordinal, lags,
    n, rss_without, rss_with, f, p_value. A candidate that leaves no residual has
    an infinite F and p 0; a measure that its own lags explain fully has neither.
    """
    max_lag = spec.causal_lags if max_lag is None else max_lag
    by = [*spec.keys, "variable", "ordinal"]
    paired = long.dropna(subset=["x", "y"])
    series = Window.partitionBy(*spec.keys, "variable")
    enough = F.count(F.lit(1)).over(series) > spec.causal_min_rows
    standard = paired.withColumn("_enough", enough).filter("_enough")
    standard = standard.withColumns(
        {
            c: F.coalesce(
                F.try_divide(F.col(c) - F.avg(c).over(series), F.stddev_pop(c).over(series)), F.lit(0.0)
            )
            for c in ("x", "y")
        }
    )
    ordered = series.orderBy(*spec.time)
    lagged = standard.withColumns(
        {f"{c}{k}": F.lag(c, k).over(ordered) for c in ("y", "x") for k in range(1, max_lag + 1)}
    )
    tests = []
    for lags in range(1, max_lag + 1):
        usable = F.col(f"y{lags}").isNotNull()
        columns = [F.col(f"{c}{k}") for c in ("y", "x") for k in range(1, lags + 1)]
        sums = cross_products([F.when(usable, c) for c in columns], F.when(usable, F.col("y")), usable)
        tests.append(F.struct(F.lit(lags).alias("lags"), F.count_if(usable).alias("n"), sums.alias("sums")))
    tested = (
        lagged.groupBy(*by)
        .agg(F.array(*tests).alias("tests"))
        .select(*by, F.inline("tests"))
        .filter(F.col("n") > 2 * F.col("lags") + 1)
        .withColumn("fit", residual_sums("sums", "lags"))
    )
    bottom = F.col("n") - 2 * F.col("lags") - 1
    gain = (F.col("fit.rss_without") - F.col("fit.rss_with")) / F.col("lags")
    tested = tested.select(
        *by,
        "lags",
        "n",
        "fit.rss_without",
        "fit.rss_with",
        F.when(F.col("fit.rss_without") <= EXACT_FIT, None)
        .when((F.col("fit.rss_with") <= EXACT_FIT * F.col("fit.rss_without")) & (gain > 0), F.lit(float("inf")))
        .otherwise(F.greatest(gain / (F.col("fit.rss_with") / bottom), F.lit(0.0)))
        .alias("f"),
    )
    p = f_upper_tail(F.col("f"), F.col("lags").cast("double"), bottom.cast("double"))
    return tested.withColumn("p_value", p)


def causality_scores(long: DataFrame, spec: PanelSpec, max_lag: int | None = None) -> DataFrame:
    """Smallest p-value over the lag lengths, per series and candidate."""
    tests = causality_tests(long, spec, max_lag)
    return tests.groupBy(*spec.keys, "variable", "ordinal").agg(F.min("p_value").alias("score"))


def tree_importance(
    train: DataFrame, spec: PanelSpec, names: Sequence[str], rounds: int = 100, depth: int | None = None
) -> DataFrame:
    """Impurity importance of each candidate in a random forest of its series: keys, variable, score.

    Missing values count as zero. The importances of a series sum to one, or are
    all zero where its measure does not vary.
    """
    inputs = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names]
    series = training_series(train, spec, inputs, spec.time)
    forest = regressor("rf", rounds, depth)("y", "x", F.lit(len(names)))
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.arrays_zip(labels.alias("variable"), F.col("forest.importance").alias("score"))
    return series.select(*spec.keys, forest.alias("forest")).select(*spec.keys, F.inline(pairs))


def choose(
    usable: DataFrame,
    scores: DataFrame | None,
    spec: PanelSpec,
    ascending: bool = False,
    positive: bool = True,
    top: int = TOP,
) -> DataFrame:
    """Top candidates per series as an array, best first.

    ``scores`` has keys, variable and score; without scores, or where none
    qualifies, the first candidates in column order are taken.
    """
    by = Window.partitionBy(*spec.keys)
    if scores is None:
        ranked = usable.withColumn("qualified", F.lit(False)).withColumn("score", F.lit(None).cast("double"))
    else:
        joined = usable.join(
            scores.select(*spec.keys, "variable", "score"), [*spec.keys, "variable"], "left"
        )
        passes = F.col("score").isNotNull()
        if positive:
            passes = passes & (F.col("score") > 0)
        ranked = joined.withColumn("qualified", passes)
    order = F.col("score").asc_nulls_last() if ascending else F.col("score").desc_nulls_last()
    placed = ranked.withColumns(
        {
            "any_qualified": F.max("qualified").over(by),
            "place": F.row_number().over(by.orderBy(F.col("qualified").desc(), order, "ordinal")),
            "first": F.row_number().over(by.orderBy("ordinal")),
        }
    )
    position = F.when(F.col("any_qualified"), F.col("place")).otherwise(F.col("first"))
    keep = (~F.col("any_qualified") | F.col("qualified")) & (position <= top)
    return (
        placed.filter(keep)
        .groupBy(*spec.keys)
        .agg(F.array_sort(F.collect_list(F.struct(position.alias("place"), "variable"))).alias("picked"))
        .select(*spec.keys, F.transform("picked", lambda p: p["variable"]).alias("exo_vars"))
    )


def without_gaps(
    selection: DataFrame, rows: DataFrame, spec: PanelSpec, names: Sequence[str], rule: str = "any"
) -> DataFrame:
    """Remove variables a series has no values for from its selection.

    ``rule='any'`` removes a variable with a single missing value among the
    rows of the series, ``'all'`` one without any value.
    """
    if not names:
        return selection
    spoilt = F.bool_or if rule == "any" else F.bool_and
    gaps = F.array(*[F.when(spoilt(F.col(n).isNull()), F.lit(n)) for n in names])
    unusable = rows.groupBy(*spec.keys).agg(F.array_compact(gaps).alias("gaps"))
    return (
        selection.join(unusable, list(spec.keys), "left")
        .withColumn(
            "exo_vars", F.array_except("exo_vars", F.coalesce("gaps", F.array().cast("array<string>")))
        )
        .drop("gaps")
    )


def select_variables(
    train: DataFrame,
    spec: PanelSpec,
    names: Sequence[str],
    arima_names: Sequence[str],
    importance_rounds: int = 100,
    models: Sequence[str] = ("sarimax", "prophet", "rf", "xgb", "lgb"),
) -> dict[str, DataFrame]:
    """Chosen variables of each of the ``models`` that takes any: mutual
    information for 'prophet' and 'xgb', forest importance for 'rf', Granger
    causality for 'sarimax', column order for 'lgb'."""
    if not names:
        return {}
    long = long_form(train.dropna(subset=[spec.value]), spec, names)
    usable = varying(long, spec)
    arima_long = long.filter(F.col("variable").isin(*arima_names)) if arima_names else long.limit(0)
    arima_usable = usable.filter(F.col("variable").isin(*arima_names)) if arima_names else usable.limit(0)
    by_information = choose(usable, mutual_information(long, spec), spec)
    chosen = {
        "sarimax": lambda: choose(arima_usable, causality_scores(arima_long, spec), spec, True, False),
        "prophet": lambda: by_information,
        "rf": lambda: choose(usable, tree_importance(train, spec, names, importance_rounds), spec),
        "xgb": lambda: by_information,
        "lgb": lambda: choose(usable, None, spec),
    }
    return {m: made() for m, made in chosen.items() if m in models}
