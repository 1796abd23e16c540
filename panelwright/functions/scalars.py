"""Column functions without any ordering or grouping.

Each takes a column name or Column and returns a Column, so all of them stay
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The margin that keeps probabilities inside the open unit
# interval, and the year whose January is month 1.
UNIT_MARGIN = 1e-10
MONTH_ONE_YEAR = 1980

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- indicators ------------------------------------------------------------


def _flag(condition: Column) -> Column:
    """0/1 from a condition, with an unknown condition counted as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def greq(c: ColumnLike, value: float) -> Column:
    """1 where the value is at least `value`; 0 otherwise, also on missing."""
    return _flag(as_column(c) >= value)


def smeq(c: ColumnLike, value: float) -> Column:
    """1 where the value is at most `value`; 0 otherwise, also on missing."""
    return _flag(as_column(c) <= value)


def in_range(
    c: ColumnLike, low: float, high: float, strict_compat: bool = False
) -> Column:
    """1 inside the closed range, else 0.

    A missing value gives 0. `strict_compat` gives -1 there, which is what the
    sum of two one-sided indicators minus one amounts to.
    """
    if strict_compat:
        return smeq(c, high) + greq(c, low) - F.lit(1)
    return _flag(as_column(c).between(low, high))


def to_dummy(c: ColumnLike) -> Column:
    """1 for a positive count, 0 for any other, missing stays missing."""
    c = as_column(c)
    return F.when(c > 0, 1).when(c.isNotNull(), 0)


# --- arithmetic ------------------------------------------------------------


def decay(c: ColumnLike, halflife: float) -> Column:
    """Halve once per `halflife` units of the input."""
    return F.pow(F.lit(2.0), -as_column(c) / F.lit(float(halflife)))


def ln(c: ColumnLike) -> Column:
    """Natural log of one plus the value."""
    return F.log1p(as_column(c))


def clip(c: ColumnLike, low: ColumnLike | float, high: ColumnLike | float) -> Column:
    """Bound a value from both sides; a missing value stays missing."""
    c = as_column(c)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def clip_unit(c: ColumnLike) -> Column:
    """Pull a probability off 0 and 1."""
    return clip(c, UNIT_MARGIN, 1 - UNIT_MARGIN)


def prob_to_odds(p: ColumnLike, clipped: bool = True) -> Column:
    """Odds of a probability; a certain one has infinite odds if not clipped."""
    p = clip_unit(p) if clipped else as_column(p)
    return F.when(p == 1, F.lit(float("inf"))).otherwise(
        F.try_divide(p, F.lit(1.0) - p)
    )


def prob_to_logodds(p: ColumnLike) -> Column:
    return F.log(prob_to_odds(p))


def odds_to_prob(odds: ColumnLike) -> Column:
    odds = as_column(odds)
    return odds / (odds + F.lit(1.0))


def logodds_to_prob(logodds: ColumnLike) -> Column:
    """The logistic function, written so that large inputs do not overflow."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_column(logodds)))


# --- several columns of one row -------------------------------------------


def row_sum(cols: Sequence[ColumnLike]) -> Column:
    """Sum over columns; missing counts as 0, so an all-missing row gives 0."""
    parts = [F.coalesce(as_column(c).cast("double"), F.lit(0.0)) for c in cols]
    return reduce(lambda a, b: a + b, parts)


def row_product(cols: Sequence[ColumnLike]) -> Column:
    """Product over columns; missing counts as 1."""
    parts = [F.coalesce(as_column(c).cast("double"), F.lit(1.0)) for c in cols]
    return reduce(lambda a, b: a * b, parts)


def row_mean(cols: Sequence[ColumnLike]) -> Column:
    """Mean over the columns that are present; missing if none is."""
    cols = [as_column(c) for c in cols]
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.when(present > 0, row_sum(cols) / present)


def row_greatest(cols: Sequence[ColumnLike]) -> Column:
    """Largest value of the row, ignoring missing ones."""
    cols = [as_column(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def zero_if_missing(c: ColumnLike) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def one_if_missing(c: ColumnLike) -> Column:
    """For an indicator of missing observation: 1 where nothing was recorded."""
    return F.coalesce(as_column(c), F.lit(1))


# --- sums over rows --------------------------------------------------------


def steady_sum(c: ColumnLike, places: int = 4) -> Column:
    """Aggregate: a sum that does not depend on the order of the rows, where all
    values have at most `places` decimals; they are summed as whole numbers. So
    29.27 + 10.73 is 40 and no hair less, on any number of tasks. Other values
    are summed as they are."""
    c = as_column(c).cast("double")
    unit = F.lit(10.0**places)
    # Larger ones, infinities and NaN do not fit; `rint` is exact on the rest.
    whole = F.when(F.abs(c) < 1e11, F.rint(c * unit).cast("long"))
    fits = F.when(whole / unit == c, whole)
    return F.coalesce(F.when(F.count(fits) == F.count(c), F.try_sum(fits) / unit), F.sum(c))


# --- codes and names -------------------------------------------------------


def recode(c: ColumnLike, rules: Sequence[tuple[object, object]]) -> Column:
    """Apply (old, new) rules one after the other.

    A later rule sees the output of an earlier one. The rules are folded into
    one map from each original value to its final value, so the plan holds one
    CASE and not a tower of them.
    """
    final: dict[object, object] = {}
    for old, new in rules:
        for origin, current in final.items():
            if current == old:
                final[origin] = new
        final.setdefault(old, new)
    out = as_column(c)
    expr = None
    for origin, target in final.items():
        branch = out == F.lit(origin)
        expr = (
            F.when(branch, F.lit(target))
            if expr is None
            else expr.when(branch, F.lit(target))
        )
    return out if expr is None else expr.otherwise(out)


def last_match(rules: Sequence[tuple[Column, object]]) -> Column:
    """Value of the last rule whose condition holds; missing if none does."""
    expr = None
    for condition, value in reversed(rules):
        expr = (
            F.when(condition, F.lit(value))
            if expr is None
            else expr.when(condition, F.lit(value))
        )
    if expr is None:
        return F.lit(None)
    return expr


def tag_letters(rules: Mapping[str, Column]) -> Column:
    """Concatenate the letters whose condition holds, missing if there is none."""
    text = F.concat(
        *[F.when(cond, F.lit(letter)).otherwise(F.lit("")) for letter, cond in rules.items()]
    )
    return F.when(text != "", text)


def clean_name(c: ColumnLike) -> Column:
    """Lower case with blanks, dashes and slashes as single underscores.

    Two passes over doubled underscores, so runs of up to four collapse.
    """
    text = F.regexp_replace(F.lower(as_column(c)), "[ \\-/]", "_")
    return F.replace(F.replace(text, F.lit("__"), F.lit("_")), F.lit("__"), F.lit("_"))


def split_names(c: ColumnLike, separator: str = "/") -> Column:
    """Array of the names in a joined name, to be exploded."""
    return F.split(as_column(c), separator)


# --- dates -----------------------------------------------------------------


def month_id(year: ColumnLike, month: ColumnLike) -> Column:
    """Running month number, 1 being January of the first year."""
    return (as_column(year) - MONTH_ONE_YEAR) * 12 + as_column(month)


def month_id_of(date: ColumnLike) -> Column:
    date = as_column(date)
    return month_id(F.year(date), F.month(date))


# --- space -----------------------------------------------------------------


def grid_id(lat: ColumnLike, lon: ColumnLike) -> Column:
    """Id of the half-degree cell around a point; the south-west cell is 1."""
    row = F.floor((as_column(lat) + 90) * 2)
    col = F.floor((as_column(lon) + 180) * 2)
    return row * 720 + col + 1


def parent_grid_id(cell: ColumnLike) -> Column:
    """Id of the one-degree cell that covers a half-degree cell."""
    zero = as_column(cell) - 1
    row = F.floor(F.floor(zero / 720) / 2)
    col = F.floor((zero % 720) / 2)
    return (row * 360 + col + 1).cast("long")


def point_from_wkt(text: ColumnLike) -> Column:
    """Struct (x, y) from `POINT(x y)`; empty or other text gives missing."""
    pattern = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"
    text = as_column(text)
    x = F.regexp_extract(text, pattern, 1)
    y = F.regexp_extract(text, pattern, 2)
    return F.when(
        x != "",
        F.struct(x.try_cast("double").alias("x"), y.try_cast("double").alias("y")),
    )
