"""The panel descriptor, forecast periods and the missing-value rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class Panel:
    """Names of the time and group key of a panel; rows are unique per pair."""

    time: str = "t"
    group: str = "g"

    @property
    def keys(self) -> list[str]:
        return [self.time, self.group]

    def window(self) -> WindowSpec:
        """All rows of a group in time order."""
        return Window.partitionBy(self.group).orderBy(self.time)

    def rows(self, first: int, last: int) -> WindowSpec:
        """A row frame around the current row of a group."""
        return self.window().rowsBetween(first, last)

    def values(self, df: DataFrame) -> list[str]:
        """Every column that is not a key."""
        return [c for c in df.columns if c not in self.keys]


@dataclass(frozen=True)
class Period:
    """Closed train and predict ranges of integer time ids."""

    name: str
    train_start: int
    train_end: int
    predict_start: int
    predict_end: int

    def in_train(self, time: Column) -> Column:
        return time.between(self.train_start, self.train_end)

    def in_predict(self, time: Column) -> Column:
        return time.between(self.predict_start, self.predict_end)

    def overlaps(self, other: "Period") -> bool:
        """Whether the two predict ranges share a time."""
        return (
            self.predict_start <= other.predict_end
            and other.predict_start <= self.predict_end
        )


def predict_ranges_disjoint(periods: list[Period]) -> bool:
    return not any(
        a.overlaps(b) for i, a in enumerate(periods) for b in periods[i + 1 :]
    )


def drop_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column.

    All operators treat NULL as the only missing value, so sources call this
    once and nothing downstream has to think about NaN, which Spark orders
    above every number.
    """
    floating = {
        f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))
    }
    return df.select(
        *[
            F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floating else F.col(c)
            for c in df.columns
        ]
    )


def require_columns(df: DataFrame, needed: list[str], who: str) -> None:
    """Raise when a frame lacks columns an operator reads."""
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"{who} needs columns that are not there: {absent}")
