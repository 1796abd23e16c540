"""Bringing source rows onto a skeleton: the steps that sources share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import recode
from panelwright.operators.joins import join_latest_code, left_join_keeping_rows
from panelwright.operators.missing import extrapolate, fill_groups_with_time_means
from panelwright.operators.reshape import (
    drop_by_suffix,
    drop_totally_missing,
    first_per_key,
    flip_years,
    one_hot,
    prefix_columns,
    sorted_columns,
    tidy_columns,
    tidy_name,
)
from panelwright.panel import Panel

# Endings of measurement columns that are not used.
UNUSED_SUFFIXES = ("_codehigh", "_codelow", "_ord", "_sd", "_mean", "_nr", "_osp")


@dataclass(frozen=True)
class Staging:
    """How a source gets its group id, column prefix and filling."""

    panel: Panel
    prefix: str
    code: str
    lookup: DataFrame
    fill: Callable[[DataFrame, Panel], DataFrame] | None = None
    drop_empty: bool = False


def stage(df: DataFrame, skeleton: DataFrame, how: Staging) -> DataFrame:
    """Source rows with codes to prefixed columns on every skeleton row.

    Codes become group ids by the newest id of a code; rows whose code is not
    known are left out. The source then joins the skeleton from the left, so
    the result has exactly the skeleton's rows.
    """
    panel = how.panel
    keyed = join_latest_code(df, how.lookup, how.code, panel.group).drop(how.code)
    keyed = prefix_columns(keyed, how.prefix, keep=panel.keys)
    out = left_join_keeping_rows(skeleton.select(*panel.keys), keyed, panel.keys)
    if how.drop_empty:
        out = drop_totally_missing(out, panel.keys)
    if how.fill is not None:
        out = how.fill(out, panel)
    return sorted_columns(out, panel.keys)


def indicators_by_year(
    wide: DataFrame, code: str, indicator: str, names: Sequence[str]
) -> DataFrame:
    """Years as columns to (code, year) rows with a tidy column per indicator."""
    years = [c for c in wide.columns if c.isdigit()]
    flipped = flip_years(wide, [code], indicator, years, names)
    return flipped.toDF(
        *[c if c in (code, "year") else tidy_name(c) for c in flipped.columns]
    )


def leader_months(
    df: DataFrame,
    code_fixes: Sequence[tuple[int, int]],
    regimes: Sequence[str],
    ties: Sequence[str] = ("leader",),
) -> DataFrame:
    """One row per country and month, the shortest tenure first, with regime
    type as 0/1 columns. Codes are fixed in the order given."""
    fixed = df.withColumn("ccode", recode("ccode", code_fixes))
    first = first_per_key(fixed, ["ccode", "year", "month"], ["tenure_months", *ties])
    return one_hot(first, "government", "gov", regimes, tidy=True)


def yearly_measures(df: DataFrame, meta: Sequence[str] = ()) -> DataFrame:
    """Tidy names without description columns and unused endings."""
    return drop_by_suffix(tidy_columns(df).drop(*meta), UNUSED_SUFFIXES)


def extrapolated_with_time_means(df: DataFrame, panel: Panel) -> DataFrame:
    """Interpolate groups, then give groups without data the time means."""
    return fill_groups_with_time_means(extrapolate(df, panel), panel)


def watch_list_panel(
    entries: DataFrame, skeleton: DataFrame, panel: Panel, flags: Sequence[str], prefix: str
) -> DataFrame:
    """Monthly entries on the skeleton; months without data are unobserved.

    Entries are keyed by the panel. Flags are interpolated as other sources
    are; where a group has none at all, `unobserved` is 1 and the others 0.
    """
    out = left_join_keeping_rows(
        skeleton.select(*panel.keys),
        entries.select(*panel.keys, *flags, "unobserved"),
        panel.keys,
    )
    out = extrapolate(out, panel)
    out = out.select(
        *panel.keys,
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in flags],
        F.coalesce("unobserved", F.lit(1.0)).alias("unobserved"),
    )
    return sorted_columns(prefix_columns(out, prefix, keep=panel.keys), panel.keys)


def greatest_of_variants(df: DataFrame, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The larger of a static and a yearly variant, as a new column."""
    return df.select("*", *[F.greatest(a, b).alias(n) for n, (a, b) in names.items()])
