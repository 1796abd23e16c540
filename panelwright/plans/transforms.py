"""Named transforms and how a set of them is put into few window passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from panelwright.functions import scalars, windows
from panelwright.functions.windows import Spell
from panelwright.operators import spatial
from panelwright.panel import Panel

# Column transforms of one input: (column, panel, **arguments) -> Column.
SERIES: dict[str, Callable[..., Column]] = {
    "delta": windows.delta,
    "greq": lambda c, panel, value: scalars.greq(c, value),
    "smeq": lambda c, panel, value: scalars.smeq(c, value),
    "in_range": lambda c, panel, low, high, **kw: scalars.in_range(c, low, high, **kw),
    "tlag": windows.tlag,
    "tlead": windows.tlead,
    "moving_average": windows.moving_average,
    "decay": lambda c, panel, halflife: scalars.decay(c, halflife),
    "mean": windows.group_mean,
    "ln": lambda c, panel: scalars.ln(c),
    "demean": windows.demean,
    "rollmax": windows.rollmax,
    "onset_possible": windows.onset_possible,
    "onset": windows.onset,
}
# Column transforms of several inputs.
ROWS: dict[str, Callable[[Sequence[str]], Column]] = {
    "sum": scalars.row_sum,
    "product": scalars.row_product,
}
SPELLS = ("cweq", "time_since")
SPATIAL = ("spdist", "stdist", "splag")


@dataclass
class Transform:
    """A named transform: function, one `col` or several `cols`, arguments."""

    name: str
    f: str
    cols: list[str]
    args: dict[str, Any] = field(default_factory=dict)

    @staticmethod
    def parse(name: str, spec: Mapping[str, Any]) -> "Transform":
        spec = dict(spec)
        if "f" not in spec:
            raise KeyError(f"transform {name} names no function f")
        f = spec.pop("f")
        known = [*SERIES, *ROWS, *SPELLS, *SPATIAL]
        if f not in known:
            raise KeyError(f"transform {name}: f={f} is not one of {known}")
        if "cols" in spec:
            cols = spec.pop("cols")
        elif "col" in spec:
            cols = [spec.pop("col")]
        else:
            raise KeyError(f"transform {name} needs col or cols")
        if not isinstance(cols, list) or not all(isinstance(c, str) for c in cols):
            raise TypeError(f"transform {name}: col is a string and cols a list of strings")
        return Transform(name, f, cols, spec)


@dataclass(frozen=True)
class Space:
    """What spatial transforms need: neighbours, centroid columns, cell size."""

    adjacency: DataFrame | None = None
    x: str = "x"
    y: str = "y"
    cell: float = 0.5


def levels(transforms: Sequence[Transform], available: Sequence[str]) -> list[list[Transform]]:
    """Group transforms so that each group only reads what is there before it."""
    have, left, out = set(available), list(transforms), []
    while left:
        ready = [t for t in left if set(t.cols) <= have]
        if not ready:
            raise ValueError(
                "transforms read columns that nothing provides: "
                f"{ {t.name: sorted(set(t.cols) - have) for t in left} }"
            )
        out.append(ready)
        have |= {t.name for t in ready}
        left = [t for t in left if t not in ready]
    return out


def apply_transforms(
    df: DataFrame,
    panel: Panel,
    specs: Mapping[str, Mapping[str, Any]] | Sequence[Transform],
    space: Space = Space(),
) -> DataFrame:
    """Add all named transforms, which may read each other.

    Transforms of a level become one `select`, so their windows share one
    shuffle and sort; spell counters of a level share another; spatial sums
    with the same neighbourhood share one join.
    """
    if isinstance(specs, Mapping):
        specs = [Transform.parse(n, s) for n, s in specs.items()]
    for level in levels(specs, df.columns):
        plain = [t for t in level if t.f in SERIES or t.f in ROWS]
        spells = [t for t in level if t.f in SPELLS]
        if plain:
            df = df.select(
                "*",
                *[
                    (
                        SERIES[t.f](t.cols[0], panel, **t.args)
                        if t.f in SERIES
                        else ROWS[t.f](t.cols)
                    ).alias(t.name)
                    for t in plain
                ],
            )
        if spells:
            df = windows.spell_counts(
                df,
                panel,
                [
                    Spell(
                        t.name,
                        t.cols[0],
                        t.args.get("value", 0),
                        t.args.get("seed"),
                        lagged=t.f == "time_since",
                    )
                    for t in spells
                ],
            )
        df = _spatial(df, panel, [t for t in level if t.f in SPATIAL], space)
    return df


def _spatial(df: DataFrame, panel: Panel, transforms: list[Transform], space: Space) -> DataFrame:
    lags: dict[tuple[int, int], dict[str, str]] = {}
    for t in transforms:
        if t.f == "splag":
            order = (t.args.get("first", 1), t.args.get("last", 1))
            # A column may be asked for twice under different names.
            if t.cols[0] in lags.setdefault(order, {}):
                df = spatial.spatial_lag(
                    df, panel, space.adjacency, t.cols[0], *order, out=t.name
                )
            else:
                lags[order][t.cols[0]] = t.name
    for (first, last), cols in lags.items():
        pairs = spatial.neighbours_of_order(space.adjacency, first, last).select("g", "n")
        df = spatial.spatial_sum(df, panel, pairs, cols)
    for t in transforms:
        args = dict(t.args)
        if "fill_value" in args:
            args["fill"] = args.pop("fill_value")
        if t.f == "spdist":
            df = spatial.distance_to_event(
                df, panel, t.cols[0], space.x, space.y, cell=space.cell, out=t.name, **args
            )
        elif t.f == "stdist":
            df = spatial.spacetime_distance_to_event(
                df, panel, t.cols[0], space.x, space.y, cell=space.cell, out=t.name, **args
            )
    return df
