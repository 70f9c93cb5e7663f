"""Panel forecasting as DataFrame-to-DataFrame operators on Spark."""

from loomcast.spec import MONTHLY, YEARLY, PanelSpec

__all__ = ["MONTHLY", "YEARLY", "PanelSpec"]
