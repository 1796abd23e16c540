"""Skeletons and balancing: which (time, group) rows a panel has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.panel import Panel


def skeleton_between(groups: DataFrame, panel: Panel, first, last) -> DataFrame:
    """Every group at every time of a closed range.

    Each group row unfolds into its own times, which stays a narrow step: no
    product of two tables is formed.
    """
    as_long = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("long")
    times = F.explode(F.sequence(as_long(first), as_long(last)))
    rest = [c for c in groups.columns if c != panel.time]
    return groups.select(times.alias(panel.time), *rest)


def cell_skeleton(
    cell_times: DataFrame,
    times: DataFrame,
    cell_group: DataFrame,
    time: str,
    cell: str,
    year: str,
    before_year: int,
) -> DataFrame:
    """Cell rows with calendar columns and the country of their year.

    The mapping of cells to countries may stop before the calendar does, so it
    is joined from the left; the calendar must match.
    """
    return (
        cell_times.join(times, time)
        .filter(F.col(year) < before_year)
        .join(cell_group, [cell, year], "left")
    )


def only_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag, boolean or 0/1, is set."""
    return df.filter(F.col(flag).cast("boolean"))


def between_times(df: DataFrame, time: str, first: int, last: int) -> DataFrame:
    return df.filter(F.col(time).between(first, last))


def groups_at_last_time(df: DataFrame, panel: Panel) -> DataFrame:
    """Groups that have a row at the last time of the panel."""
    last = df.agg(F.max(panel.time)).scalar()
    return df.filter(F.col(panel.time) == last).select(panel.group).distinct()


def observed_times(df: DataFrame, panel: Panel) -> Column:
    """The distinct times of a panel as one array.

    Duplicates are dropped in every task before anything is sent, so what
    meets in one place is the calendar, however long the panel is.
    """
    return df.agg(F.array_sort(F.collect_set(panel.time))).scalar()


def balance_last_t(df: DataFrame, panel: Panel) -> DataFrame:
    """All observed times for exactly the groups present at the last time.

    Each group unfolds over the array of times, so gaps in the calendar stay
    gaps and no product of two tables is formed.
    """
    members = groups_at_last_time(df, panel)
    full = members.select(F.explode(observed_times(df, panel)).alias(panel.time), panel.group)
    return full.join(df, panel.keys, "left").select(*df.columns)


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))
