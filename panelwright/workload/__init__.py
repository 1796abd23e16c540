"""Queries over the given tables, one or more per operator, with SQL twins."""

from panelwright.workload import (  # noqa: F401
    aggregates,
    columns,
    forecasting,
    gaps,
    joins,
    scoring,
    series,
    space,
    staging,
)
from panelwright.workload.base import REGISTRY

__all__ = ["REGISTRY"]
