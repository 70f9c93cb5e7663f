"""Fitted models on disk: parameter table and settings."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from loomcast.operators.models.base import Fitted, PathModel
from loomcast.operators.models.fourier import FourierModel
from loomcast.operators.models.trees import TreeModel
from loomcast.sources.tables import read_table, write_table
from loomcast.spec import PanelSpec

KINDS = {c.__name__: c for c in (PathModel, FourierModel, TreeModel)}


def save_fitted(fitted: Fitted, path: str) -> None:
    """Write a fitted model; series are rows of a table, not files of their own."""
    settings = {
        "kind": type(fitted).__name__,
        "name": fitted.name,
        "names": fitted.names,
        "baseline": fitted.baseline,
    }
    if isinstance(fitted, FourierModel):
        settings["shape"] = [fitted.season, list(fitted.breaks), fitted.order]
    write_table(fitted.parameters, f"{path}/parameters")
    spark = fitted.parameters.sparkSession
    write_table(spark.createDataFrame([(json.dumps(settings),)], "settings string"), f"{path}/settings")


def load_fitted(spark: SparkSession, path: str, spec: PanelSpec) -> Fitted:
    """Read a fitted model back, ready to score."""
    settings = json.loads(read_table(spark, f"{path}/settings").first().settings)
    made = KINDS[settings["kind"]](
        settings["name"], spec, settings["names"], read_table(spark, f"{path}/parameters"), settings["baseline"]
    )
    if "shape" in settings:
        made.season, made.breaks, made.order = settings["shape"]
    return made
