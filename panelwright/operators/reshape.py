"""Column selection, wide and long forms, dedupe and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelwright.functions.scalars import clean_name


def subset(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys and those wanted columns that the source has."""
    return df.select(*keys, *[c for c in cols if c in df.columns and c not in keys])


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column but the kept ones, unless it has the prefix."""
    return df.select(
        *[
            F.col(f"`{c}`").alias(c if c in keep or c.startswith(prefix) else prefix + c)
            for c in df.columns
        ]
    )


def tidy_name(name: str) -> str:
    return name.replace(" ", "").replace(".", "_").lower()


def tidy_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names without blanks or dots."""
    return df.toDF(*[tidy_name(c) for c in df.columns])


def drop_by_suffix(df: DataFrame, suffixes: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(tuple(suffixes))])


def sorted_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys first, the other columns by name."""
    return df.select(*keys, *sorted(c for c in df.columns if c not in keys))


def totally_missing_columns(df: DataFrame) -> list[str]:
    """Columns without a single value: one aggregate for all of them."""
    if not df.columns:
        return []
    row = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]


def drop_totally_missing(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in totally_missing_columns(df) if c not in keys])


def missing_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share missing per column and over all cells, in long form."""
    shares = [F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols]
    wide = df.agg(*shares)
    overall = sum((F.col(c) for c in cols), F.lit(0.0)) / F.lit(float(len(cols)))
    wide = wide.select(*cols, overall.alias("overall"))
    return wide.unpivot([], [*cols, "overall"], "column", "share_missing")


def one_hot(
    df: DataFrame,
    col: str,
    prefix: str,
    values: Sequence,
    tidy: bool = False,
) -> DataFrame:
    """Add a 0/1 column `<prefix>_<value>` for each given value of a category.

    The values are columns of the result, so they are given and not searched
    for; for a category whose values are not known `category_rows` has rows."""
    if tidy:
        df = df.withColumn(col, clean_name(col))
    dummies = {
        f"{prefix}_{v}": F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0))
        for v in values
    }
    return df.select("*", *[c.alias(name) for name, c in dummies.items()])


def category_rows(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """The long form of `one_hot`: one row per key and value that occurs with
    it, and the number of rows with both."""
    known = df.filter(F.col(col).isNotNull())
    return known.groupBy(*keys, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row of each key in the given order.

    An aggregate and not a window: the minimum of a struct combines before the
    shuffle, so a key that holds a large share of the rows does no harm. A
    missing value sorts behind all others. The order must tell rows apart for
    the choice to be reproducible.
    """
    fields = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(
        *[f.alias(f"o{i}{k}") for i, o in enumerate(fields) for k, f in (("n", o.isNull()), ("v", o))]
    )
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), rank).alias("_row")
    )
    return best.select(*df.columns) if not rest else best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def wide_to_long(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str
) -> DataFrame:
    """Columns to rows; missing cells give no row."""
    return df.unpivot(list(ids), list(cols), name, value).filter(F.col(value).isNotNull())


def long_to_wide(
    df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence
) -> DataFrame:
    """Rows to one column per given name; the names are always explicit."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def flip_years(
    df: DataFrame, ids: Sequence[str], indicator: str, years: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Years as columns to one row per (ids, year) with a column per indicator."""
    long = wide_to_long(df, [*ids, indicator], years, "year", "value")
    long = long.withColumn("year", F.col("year").cast("int"))
    return long_to_wide(long, [*ids, "year"], indicator, "value", names)


def numeric_columns(df: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, NumericType) and f.name not in keys
    ]


def bounding_box(df: DataFrame, x: str, y: str, padding: float = 0.5) -> DataFrame:
    return df.agg(
        (F.min(x) - padding).alias("min_x"),
        (F.max(x) + padding).alias("max_x"),
        (F.min(y) - padding).alias("min_y"),
        (F.max(y) + padding).alias("max_y"),
    )


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with `<col>_min` and `<col>_max`."""
    return df.agg(
        *[F.min(c).alias(f"{c}_min") for c in cols],
        *[F.max(c).alias(f"{c}_max") for c in cols],
    )


def clip_to_observed(df: DataFrame, observed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bound each column by the smallest and largest value of another frame.

    All bounds are one aggregate, read as a scalar subquery.
    """
    ranges = column_ranges(observed, cols)
    bounds = ranges.select(F.struct(*ranges.columns)).scalar()

    def bounded(c: str) -> Column:
        inside = F.least(F.greatest(F.col(c), bounds[f"{c}_min"]), bounds[f"{c}_max"])
        return F.when(F.col(c).isNotNull(), inside)

    return df.select(*[bounded(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def union_all(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become missing."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.distinct() if distinct else out


def sort_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows by key, for a sink that must be ordered; columns by name."""
    return sorted_columns(df, keys).orderBy(*keys)
