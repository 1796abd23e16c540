"""Panel analytics and step-ahead forecasting as Spark jobs."""

from panelwright.panel import Panel, Period, drop_nan

__all__ = ["Panel", "Period", "drop_nan"]
