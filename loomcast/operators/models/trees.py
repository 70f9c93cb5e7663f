"""Tree ensembles, one per series: random forest and two kinds of boosting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loomcast.operators.models.base import Fitted, by_series, with_variables
from loomcast.operators.models.growing import FIELDS, Growth, attributed, boosted, forest_of, predicted
from loomcast.session import checkpoint
from loomcast.spec import PanelSpec

# Seed of every forest, and the library defaults of the three kinds.
SEED = 42
KINDS = {
    "rf": (None, Growth()),
    "xgb": (0.3, Growth(penalty=1.0, least_curvature=1.0, depth=6)),
    "lgb": (0.1, Growth(least_curvature=1e-3, least_rows=20, leaves=31)),
}
_WHOLE = ("feature", "left", "right", "roots")
_ARRAYS = (*FIELDS, "roots", "importance")
_RESULT = ", ".join(f"{f} array<{'int' if f in _WHOLE else 'double'}>" for f in _ARRAYS) + ", base double"
#: Numbers that one step of growing may hold: series of a batch times trees, rows and variables.
_BATCH = 1 << 20


def regressor(kind: str, rounds: int, depth: int | None = None):
    """Pandas UDF from the training values and variables of a series (row after row) to its forest."""
    rate, how = KINDS[kind]
    if depth is not None:
        how = Growth(how.penalty, how.least_curvature, how.least_rows, depth, how.leaves)

    def fitted(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
        most = max(len(y) for y, _ in parts)
        y, weight = np.zeros((len(parts), most)), np.zeros((len(parts), most))
        x = np.full((len(parts), most, parts[0][1].shape[1]), np.inf)  # rows beyond a series' own come last in every order
        for i, (own_y, own_x) in enumerate(parts):
            y[i, : len(own_y)], x[i, : len(own_y)], weight[i, : len(own_y)] = own_y, own_x, 1
        if rate is not None:
            return boosted(x, y, weight, rounds, rate, how)
        draws = np.zeros((len(parts), rounds, most), np.int64)
        for i, (own_y, _) in enumerate(parts):  # every series draws alike, whatever stands beside it
            draws[i, :, : len(own_y)] = np.random.default_rng(SEED).multinomial(len(own_y), np.full(len(own_y), 1 / len(own_y)), rounds)
        return forest_of(x, y, weight, draws, how)

    @F.pandas_udf(_RESULT)
    def run(y: pd.Series, x: pd.Series, variables: pd.Series) -> pd.DataFrame:
        parts = [
            (np.asarray(own_y, float), np.asarray(own_x, float).reshape(len(own_y), k))
            for own_y, own_x, k in zip(y, x, variables, strict=True)
        ]
        order = sorted(range(len(parts)), key=lambda i: len(parts[i][0]))
        out: list = [None] * len(parts)
        while order:
            size = max(1, len(parts[order[-1]][0]) * max(1, parts[order[-1]][1].shape[1]) * (rounds if rate is None else 1))
            some, order = order[-max(1, _BATCH // size) :], order[: -max(1, _BATCH // size)]
            for i, forest in zip(some, fitted([parts[i] for i in some]), strict=True):
                out[i] = (*(forest.get(f) for f in _ARRAYS), forest["base"])
        return pd.DataFrame(out, columns=[*_ARRAYS, "base"])

    return run


def _inputs(names: Sequence[str]) -> list[Column]:
    """Model inputs: zero for a variable that the series did not choose."""
    unused = [F.col("exo_vars").isNotNull() & ~F.array_contains("exo_vars", n) for n in names]
    return [F.when(u, 0.0).otherwise(F.col(n).cast("double")) for n, u in zip(names, unused, strict=True)]


def training_series(train: DataFrame, spec: PanelSpec, inputs: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """One row per series with complete rows: keys, ``n``, ``y`` and ``x``, in time order.

    A series is as long as the calendar, so its rows travel as arrays.
    """
    x = F.array(*inputs) if inputs else F.array().cast("array<double>")
    rows = train.select(*spec.keys, *order, F.col(spec.value).cast("double").alias("y"), x.alias("x"))
    rows = rows.filter(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    cells = F.array_sort(F.collect_list(F.struct(*order, "y", "x")))
    return by_series(rows, spec).groupBy(*spec.keys).agg(cells.alias("cells")).select(
        *spec.keys,
        F.size("cells").alias("n"),
        F.transform("cells", lambda c: c["y"]).alias("y"),
        F.flatten(F.transform("cells", lambda c: c["x"])).alias("x"),
    )


class TreeModel(Fitted):
    """Parameter table: keys, ``exo_vars``, ``n`` training rows and the forest's arrays."""

    def _with(self, rows: DataFrame, made: Sequence[T.StructField], work: Callable) -> DataFrame:
        """Rows with columns that ``work`` makes of a series' forest and inputs; rows and forest meet by series."""
        rows = rows.drop(*[f.name for f in made], "status")
        names, keys, kept = self.names, list(self.spec.keys), rows.columns
        schema = T.StructType([*rows.schema.fields, *made, T.StructField("status", T.StringType())])
        arrow = to_arrow_schema(schema)
        x = F.array(*[F.col(n).cast("double") for n in names]) if names else F.array().cast("array<double>")

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return arrow.empty_table()
            fit = right.select(["n", "exo_vars", *_ARRAYS, "base"]).to_pylist()[0]
            inputs = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in left.column("_x").chunks]).astype(float)
            inputs = inputs.reshape(left.num_rows, len(names))
            if fit["exo_vars"] is not None:
                inputs[:, [n not in fit["exo_vars"] for n in names]] = 0.0
            complete = ~np.isnan(inputs).any(axis=1)
            if fit["n"]:
                forest = {f: np.array(fit[f], np.int64 if f in _WHOLE else float) for f in (*FIELDS, "roots")} | {"base": fit["base"]}
                columns = work(forest, inputs, complete)
            else:
                columns = [[None] * left.num_rows for _ in made]
            status = np.where(complete, "ok" if fit["n"] else "too_short", "incomplete").tolist()
            arrays = [*map(left.column, kept), *(pa.array(c, arrow.field(f.name).type) for c, f in zip(columns, made, strict=True)), pa.array(status, pa.string())]
            return pa.Table.from_arrays(arrays, schema=arrow)

        series = {f"_{k}": F.col(k) for k in keys}  # names of its own, as both sides may come from one table
        fits = self.parameters.select(*[c.alias(k) for k, c in series.items()], "n", "exo_vars", *_ARRAYS, "base")
        return by_series(rows.withColumn("_x", x), self.spec).groupBy(*keys).cogroup(fits.groupBy(*series)).applyInArrow(run, schema)

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``predicted`` and ``status``; null where an input is missing."""

        def work(forest, inputs, complete):
            out = np.full(len(inputs), None, object)
            if complete.any():
                out[complete] = predicted(forest, inputs[complete])
            return [out.tolist()]

        return self._with(rows, [T.StructField("predicted", T.DoubleType())], work)

    def explained(self, rows: DataFrame) -> DataFrame:
        """``score`` with ``expected`` and the array ``parts``: one Shapley value per variable of the model."""
        made = [
            T.StructField("predicted", T.DoubleType()),
            T.StructField("expected", T.DoubleType()),
            T.StructField("parts", T.ArrayType(T.DoubleType())),
        ]

        def work(forest, inputs, complete):
            value, expected, parts = (np.full(len(inputs), None, object) for _ in made)
            if complete.any():
                found, start = attributed(forest, inputs[complete])
                value[complete], expected[complete] = predicted(forest, inputs[complete]), start
                for i, row in zip(np.flatnonzero(complete), found.tolist(), strict=True):
                    parts[i] = row
            return [value.tolist(), expected.tolist(), parts.tolist()]

        return self._with(rows, made, work)


def fit_trees(
    frame: DataFrame,
    spec: PanelSpec,
    names: Sequence[str],
    selection: DataFrame | None = None,
    kind: str = "rf",
    rounds: int = 100,
    depth: int | None = None,
    name: str | None = None,
) -> TreeModel:
    """Random forest ('rf') or boosted trees ('xgb' level by level, 'lgb' leaf by leaf), one per series.

    A series is fitted on its own rows with a measure and complete inputs, so
    its forecast depends on no other series. One without such a row has
    no forest, and its predictions stay null (``too_short``).
    """
    every = frame.select(*spec.keys).distinct()
    chosen = every.withColumn("exo_vars", F.lit(None).cast("array<string>")) if selection is None else with_variables(every, spec, selection)
    train = frame.filter((F.col("split") == "train") & F.col(spec.value).isNotNull()).drop("exo_vars").join(chosen, list(spec.keys))
    series = training_series(train, spec, _inputs(names), ["t"])
    fits = series.withColumn("fit", regressor(kind, rounds, depth)("y", "x", F.lit(len(names)))).select(*spec.keys, "n", "fit.*")
    parameters = checkpoint(chosen.join(fits, list(spec.keys), "left").fillna(0, "n"))  # fitted once, scored often
    return TreeModel(name or kind, spec, list(names), parameters)
