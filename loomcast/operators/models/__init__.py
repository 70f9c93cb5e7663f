"""Forecast models behind one interface: ``fit(frame, ...)`` -> ``score(rows)``.

A frame has the key and time columns, ``t`` (period number), the measure,
``split`` ('train' or 'test') and the candidate variables. Scoring is row-wise
on any table with the keys, ``t`` and the variables, so the same fitted model
serves the holdout, the history, the future and every what-if scenario.
"""

from loomcast.operators.models.base import Fitted, PathModel, predictions
from loomcast.operators.models.registry import MODELS, fit_model

__all__ = ["MODELS", "Fitted", "PathModel", "fit_model", "predictions"]
