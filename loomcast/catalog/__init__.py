"""Named queries over the test tables, each with its SQL where SQL can say it."""

from loomcast.catalog import (  # noqa: F401
    cleaning,
    evaluation,
    features,
    forecasting,
    integration,
    panel,
    scenarios,
    selection,
)
from loomcast.catalog.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
