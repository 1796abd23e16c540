"""Global order without a global sort in one task.

A rank over all rows is the rank inside a bucket plus the size of the buckets
before it. Only the bucket sizes, whose number is fixed, meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalars import ColumnLike, as_column
from panelwright.lineage import stored

# Digits of the hex digest that make the bucket: 16^4 buckets at most.
BUCKET_DIGITS = 4
# Digits that make a uniform number; 48 bits are exact in a double.
UNIFORM_DIGITS = 12


def digest(*parts: ColumnLike | int) -> Column:
    """Hex digest of keys, seeds and draw numbers, the same in every run."""
    return F.md5(
        F.concat_ws(
            "|",
            *[
                F.lit(str(p)) if isinstance(p, int) else as_column(p).cast("string")
                for p in parts
            ],
        )
    )


def uniform(*parts: ColumnLike | int) -> Column:
    """A number in [0, 1) that depends only on the parts."""
    head = F.substring(digest(*parts), 1, UNIFORM_DIGITS)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16**UNIFORM_DIGITS))


def _bucket_starts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of earlier buckets and of the group; one row per group and bucket."""
    sizes = df.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *by,
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(whole).alias("_total"),
    )


def with_rank(
    df: DataFrame,
    order: Column,
    ties: Sequence[str],
    out: str = "_rank",
    by: Sequence[str] = (),
    keep: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Number all rows 1..N in the order of a hex digest, per group of `by`.

    The digest spreads rows evenly over the buckets, so no bucket is hot even
    if one group has most rows. The bucket table has at most 16^4 rows per
    group; whether it is broadcast is left to Spark. `keep`
    gets the size of the group and says how many of its rows are wanted: whole
    buckets beyond that are dropped before anything is sorted.
    """
    df = df.withColumn("_digest", order).withColumn(
        "_bucket", F.substring("_digest", 1, BUCKET_DIGITS)
    )
    starts = _bucket_starts(df, by)
    ranked = df.join(starts, [*by, "_bucket"])
    if keep is not None:
        ranked = ranked.withColumn("_keep", keep(F.col("_total"))).filter("_start < _keep")
    inside = F.row_number().over(
        Window.partitionBy(*by, "_bucket").orderBy("_digest", *ties)
    )
    ranked = ranked.withColumn(out, F.col("_start") + inside)
    if keep is not None:
        ranked = ranked.filter(F.col(out) <= F.col("_keep"))
    return ranked.drop("_digest", "_bucket", "_start", "_total", "_keep")


def take_share(
    df: DataFrame,
    share: Column,
    keys: Sequence[str],
    seed: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """A reproducible sample of exactly floor(share * n) rows of each group."""
    kept = with_rank(
        df,
        digest(*keys, seed),
        keys,
        by=by,
        keep=lambda total: F.floor(share * total),
    )
    return kept.select(*df.columns)


def draw_with_replacement(
    df: DataFrame, share: float, keys: Sequence[str], seed: int
) -> DataFrame:
    """share * n rows with replacement; draw i takes the row it hashes to."""
    total = df.count()
    ranked = with_rank(df, digest(*keys, seed), keys)
    draws = df.sparkSession.range(int(share * total)).select(
        (F.floor(uniform(F.lit("draw"), F.col("id"), seed) * total) + 1).alias("_rank")
    )
    return draws.join(ranked, "_rank").select(*df.columns)


def cumulate_down(
    df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str]
) -> DataFrame:
    """Running sums in descending order of a numeric column, per group.

    A group may hold any share of the rows: rows are dealt out by ranges of
    (group, order), as many as there are shuffle partitions and of about equal
    size, summed up inside them, and shifted by the totals of the ranges above.
    The rows are written with the number of their range, as another run could
    cut the ranges elsewhere. Rows must be unique per group and order value.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *by, order).withColumn("_bucket", F.spark_partition_id())
    df = stored(dealt, "running-sums")
    totals = df.groupBy(*by, "_bucket").agg(
        *[F.sum(s).alias(f"_total_{s}") for s in sums]
    )
    above = Window.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = totals.select(
        *by,
        "_bucket",
        *[
            F.coalesce(F.sum(f"_total_{s}").over(above), F.lit(0)).alias(f"_above_{s}")
            for s in sums
        ],
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(F.desc(order)).rowsBetween(
        Window.unboundedPreceding, 0
    )
    running = df.select(
        "*", *[F.sum(s).over(inside).alias(f"_inside_{s}") for s in sums]
    )
    joined = running.join(starts, [*by, "_bucket"])
    return joined.select(
        *[c for c in df.columns if c != "_bucket"],
        *[
            (F.col(f"_inside_{s}") + F.col(f"_above_{s}")).alias(f"cum_{s}")
            for s in sums
        ],
    )


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest value, as Spark's take-ordered step. `ties`,
    in rising order, decide between equal values; missing values come last."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(c) for c in ties]).limit(k)
