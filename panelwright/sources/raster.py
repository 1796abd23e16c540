"""Raster rows (lat, lon, time, value) to panel rows of fine cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import grid_id, month_id_of, parent_grid_id
from panelwright.functions.windows import forward_fill_or
from panelwright.panel import Panel


def raster_to_coarse_months(
    raster: DataFrame, lat: str, lon: str, date: str, variable: str, value: str, names: Sequence
) -> DataFrame:
    """One row per coarse cell and month with a column per variable.

    Cell and month come from arithmetic, so no lookup is joined.
    """
    placed = raster.filter(F.col(value).isNotNull()).select(
        parent_grid_id(grid_id(lat, lon)).alias("parent"),
        month_id_of(date).cast("long").alias("month_id"),
        F.col(variable).alias("_variable"),
        F.col(value).alias("_value"),
    )
    return placed.groupBy("parent", "month_id").pivot("_variable", list(names)).agg(
        F.avg("_value")
    )


def spread_to_panel(
    skeleton: DataFrame, coarse: DataFrame, panel: Panel, names: Sequence[str]
) -> DataFrame:
    """Coarse values on every fine cell-month, last value carried, else 0."""
    keyed = skeleton.withColumn("parent", parent_grid_id(panel.group))
    joined = keyed.join(
        coarse.withColumnRenamed("month_id", panel.time), ["parent", panel.time], "left"
    )
    return joined.select(
        *skeleton.columns, *[forward_fill_or(n, panel).alias(n) for n in names]
    )
