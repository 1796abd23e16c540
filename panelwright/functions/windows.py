"""Time-ordered column functions over the rows of a group.

All of them use the same window, so any number of them in one `select` costs
one shuffle and one sort. A panel has one row per group and time; a group is
therefore never longer than the calendar, however many raw records it had.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalars import ColumnLike, as_column
from panelwright.panel import Panel


def _at_least_one(time: int, what: str) -> None:
    if time < 1:
        raise ValueError(f"{what} needs a time of at least 1, got {time}")


def tlag(c: ColumnLike, panel: Panel, time: int = 1) -> Column:
    """Value `time` rows earlier in the group (positions, not calendar)."""
    _at_least_one(time, "tlag")
    return F.lag(as_column(c), time).over(panel.window())


def tlead(c: ColumnLike, panel: Panel, time: int = 1) -> Column:
    """Value `time` rows later in the group."""
    _at_least_one(time, "tlead")
    return F.lead(as_column(c), time).over(panel.window())


def delta(c: ColumnLike, panel: Panel, time: int = 1) -> Column:
    return as_column(c) - tlag(c, panel, time)


def moving_average(c: ColumnLike, panel: Panel, time: int) -> Column:
    """Mean of the last `time` rows including this one, ignoring missing."""
    _at_least_one(time, "moving_average")
    return F.avg(as_column(c)).over(panel.rows(1 - time, 0))


def rollmax(c: ColumnLike, panel: Panel, window: int) -> Column:
    """Largest of the last `window` rows including this one."""
    return F.max(as_column(c)).over(panel.rows(1 - window, 0))


def trailing_max(c: ColumnLike, panel: Panel, window: int = 24) -> Column:
    """Largest of the `window` rows before this one."""
    return F.max(as_column(c)).over(panel.rows(-window, -1))


def group_mean(c: ColumnLike, panel: Panel) -> Column:
    """Mean of the group over all its times."""
    return F.avg(as_column(c)).over(Window.partitionBy(panel.group))


def demean(c: ColumnLike, panel: Panel) -> Column:
    return as_column(c) - group_mean(c, panel)


def forward_fill(c: ColumnLike, panel: Panel) -> Column:
    """Last value that is not missing, up to this row."""
    return F.last(as_column(c), ignorenulls=True).over(
        panel.rows(Window.unboundedPreceding, 0)
    )


def forward_fill_or(c: ColumnLike, panel: Panel, default: float = 0) -> Column:
    """Forward fill, then a default where nothing was seen yet."""
    return F.coalesce(forward_fill(c, panel), F.lit(default))


def onset_possible(c: ColumnLike, panel: Panel, window: int) -> Column:
    """1 where none of the `window` rows before this one had an event.

    Missing counts as no event, and so does the time before the first row.
    """
    frame = panel.rows(-window, -1)
    before = F.max(F.coalesce(as_column(c).cast("double"), F.lit(0.0))).over(frame)
    short = F.count(F.lit(1)).over(frame) < window
    before = F.when(short, F.greatest(F.coalesce(before, F.lit(0.0)), F.lit(0.0))).otherwise(before)
    return (before == 0).cast("int")


def onset(c: ColumnLike, panel: Panel, window: int) -> Column:
    """1 where an onset is possible and an event occurs.

    A missing value counts as an event here, the one place where it does.
    """
    event = F.coalesce(as_column(c) != 0, F.lit(True))
    return (onset_possible(c, panel, window) * event.cast("int")).cast("int")


def since_last_event(c: ColumnLike, panel: Panel, threshold: float | None = None) -> Column:
    """Time since the last row with a positive value, or one at a threshold.

    0 in a row that has the event itself, missing before the first one.
    """
    c = as_column(c)
    hit = c > 0 if threshold is None else c >= threshold
    last = F.last(F.when(hit, F.col(panel.time)), ignorenulls=True).over(
        panel.rows(Window.unboundedPreceding, 0)
    )
    return F.col(panel.time) - last


def onset_distance(c: ColumnLike, panel: Panel) -> Column:
    """At an event row, the time since the event before it; else missing."""
    c = as_column(c)
    last = F.last(F.when(c > 0, F.col(panel.time)), ignorenulls=True).over(
        panel.rows(Window.unboundedPreceding, -1)
    )
    return F.when(c > 0, F.col(panel.time) - last)


def lag_bank(cols: Sequence[str], panel: Panel, lags: Sequence[int]) -> list[Column]:
    """Every lag of every column, named `<col>_tlag<k>`, over one window."""
    return [tlag(c, panel, k).alias(f"{c}_tlag{k}") for c in cols for k in lags]


@dataclass(frozen=True)
class Spell:
    """A counter of consecutive rows in which `col` equals `value`.

    With `lagged` the counter runs over the previous row's value, which makes
    it "time since the last row that differed". A non-zero `seed` replaces the
    first count where the condition holds at the earliest time of all groups.
    """

    out: str
    col: str
    value: float = 0
    seed: float | None = None
    lagged: bool = False


def spell_counts(df: DataFrame, panel: Panel, spells: Sequence[Spell]) -> DataFrame:
    """Add any number of spell counters with one shuffle and one sort.

    The count inside a spell is the running number of matches minus that
    number at the last row that did not match. Rows with a missing value are
    passed over and stay missing.
    """
    w = panel.rows(Window.unboundedPreceding, 0)
    keep = [F.col(c) for c in df.columns]
    names = [f"_spell{i}" for i in range(len(spells))]

    read = df.select(
        *keep,
        *[
            (tlag(s.col, panel) if s.lagged else F.col(s.col)).alias(f"{n}_x")
            for n, s in zip(names, spells)
        ],
    )

    def step(name: str, spell: Spell) -> Column:
        x = F.col(f"{name}_x")
        one = F.lit(1)
        if spell.seed:
            first = read.filter(x.isNotNull()).agg(F.min(panel.time)).scalar()
            one = F.when(F.col(panel.time) == first, F.lit(spell.seed)).otherwise(one)
        return F.when(x == spell.value, one).when(x.isNotNull(), 0)

    running = read.select(
        "*",
        *[F.sum(step(n, s)).over(w).alias(f"{n}_run") for n, s in zip(names, spells)],
    )

    def count(name: str, spell: Spell) -> Column:
        x, run = F.col(f"{name}_x"), F.col(f"{name}_run")
        at_break = F.last(F.when(x != spell.value, run), ignorenulls=True).over(w)
        return F.when(x.isNotNull(), run - F.coalesce(at_break, F.lit(0)))

    return running.select(
        *keep, *[count(n, s).cast("long").alias(s.out) for n, s in zip(names, spells)]
    )


def cweq(df, panel, col, value=0, seed=None, out="cweq") -> DataFrame:
    """Count rows in a row in which a column equals a value."""
    return spell_counts(df, panel, [Spell(out, col, value, seed)])


def time_since(df, panel, col, value=0, seed=None, out="time_since") -> DataFrame:
    """Time since the column last differed from `value`, as known one row before."""
    return spell_counts(df, panel, [Spell(out, col, value, seed, lagged=True)])
