"""Tables of the Spark catalog and of databases over JDBC.

Catalog tables are the place for panels that are used again: bucketed by group
and sorted by time, they are read, windowed and joined without a shuffle. JDBC
reads and writes are split over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import stored
from panelwright.operators.reshape import tidy_name
from panelwright.panel import Panel, drop_nan

BATCH_ROWS = 10_000
# Files of a time bucket at most.
FILES_PER_BUCKET = 16


def save_table(
    df: DataFrame,
    fqtable: str,
    path: str | None = None,
    group: str | None = None,
    time: str | None = None,
    buckets: int = 200,
) -> None:
    """Replace a catalog table, with tidy column names.

    With a group column the rows are first brought together by group, so each
    bucket is one file, sorted by group and time.
    """
    tidy = df.toDF(*[tidy_name(c) for c in df.columns])
    if group is not None:
        tidy = tidy.repartition(buckets, group)
    writer = tidy.write.mode("overwrite").format("parquet")
    if group is not None:
        order = [group] if time is None else [group, time]
        writer = writer.bucketBy(buckets, group).sortBy(*order)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(fqtable)


def load_table(
    spark: SparkSession,
    fqtable: str,
    cols: Sequence[str] | None = None,
    ids: Sequence[str] = (),
) -> DataFrame:
    """A catalog table with its ids and the wanted columns."""
    df = spark.read.table(fqtable)
    if cols is not None:
        df = df.select(*dict.fromkeys([*ids, *cols]))
    return drop_nan(df)


def query_frames(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over frames that it names in braces, as `FROM {events}`."""
    return drop_nan(spark.sql(sql, **frames))


def table_options(
    fqtable: str,
    cols: Sequence[str],
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 32,
) -> dict[str, str]:
    """Options that read named columns of a table in several ranges at once."""
    wanted = ", ".join(cols) if cols else "*"
    options = {
        "dbtable": f"(SELECT {wanted} FROM {fqtable}) AS source",
        "fetchsize": str(BATCH_ROWS),
    }
    if split_on is not None:
        if lower is None or upper is None:
            raise ValueError("splitting a read needs its lower and upper bound")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    fqtable: str,
    cols: Sequence[str] | None = None,
    ids: Sequence[str] = (),
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 32,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table with its ids and the wanted columns."""
    wanted = list(dict.fromkeys([*ids, *cols])) if cols is not None else []
    options = table_options(fqtable, wanted, split_on, lower, upper, partitions)
    reader = spark.read.format("jdbc").option("url", url)
    return drop_nan(reader.options(**(properties or {})).options(**options).load())


def read_query(
    spark: SparkSession, url: str, sql: str, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of a query that the database runs."""
    reader = spark.read.format("jdbc").option("url", url).option("query", sql)
    return drop_nan(reader.options(**(properties or {})).load())


def list_columns(
    spark: SparkSession, url: str, fqtable: str, properties: Mapping[str, str] | None = None
) -> list[str]:
    """Column names; only the schema is asked for."""
    return read_table(spark, url, fqtable, properties=properties).columns


def write_table(
    df: DataFrame, url: str, fqtable: str, properties: Mapping[str, str] | None = None
) -> None:
    """Replace a table, with tidy column names, in batches from every task."""
    tidy = df.toDF(*[tidy_name(c) for c in df.columns])
    tidy.write.format("jdbc").option("url", url).option("dbtable", fqtable).option(
        "batchsize", str(BATCH_ROWS)
    ).options(**(properties or {})).mode("overwrite").save()


def column_chunks(cols: Sequence[str], n: int) -> list[list[str]]:
    """n sets of columns whose sizes differ by one at most, in order."""
    size, larger = divmod(len(cols), n)
    chunks, start = [], 0
    for i in range(n):
        stop = start + size + (1 if i < larger else 0)
        chunks.append(list(cols[start:stop]))
        start = stop
    return chunks


def split_columns(df: DataFrame, keys: Sequence[str], n: int) -> list[DataFrame]:
    """n frames that each have the keys and their part of the columns."""
    values = [c for c in df.columns if c not in keys]
    return [df.select(*keys, *chunk) for chunk in column_chunks(values, n)]


def write_split(
    df: DataFrame,
    url: str,
    fqtables: Sequence[str],
    keys: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write a wide frame to several tables, for databases with a column limit."""
    for fqtable, part in zip(fqtables, split_columns(df, keys, len(fqtables))):
        write_table(part, url, fqtable, properties)


# --- panels stored by time bucket ---------------------------------------------

BUCKET = "_bucket"


def _bucketed(df: DataFrame, panel: Panel, span: int) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col(panel.time) / span).cast("long"))


def save_by_time(df: DataFrame, path: str, panel: Panel, span: int = 12) -> None:
    """Write a panel to a folder per `span` times, to be updated bucket by bucket.

    Rows of a bucket are spread by group, so that no bucket is one task."""
    rows = _bucketed(df, panel, span)
    rows = rows.repartition(BUCKET, F.pmod(F.xxhash64(panel.group), F.lit(FILES_PER_BUCKET)))
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def load_by_time(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_by_time(source: DataFrame, path: str, panel: Panel, span: int = 12) -> list[int]:
    """Upsert by panel key into a panel of `save_by_time`; gives the buckets.

    A value of the source overwrites, a missing one does not; keys and columns
    that the stored panel lacks are added. Only the folders of times that the
    source has are read and written again, all others keep their files: columns
    new to the panel are then missing there. Buckets are few, one per `span`
    times of the source. The new rows are written aside first, so that a run that
    fails before the last write leaves the panel as it was. Repeated keys in the
    source are an error.
    """
    spark = source.sparkSession
    keys = list(panel.keys)
    if not source.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("the source has a key twice")
    touched = sorted(r[0] for r in _bucketed(source, panel, span).select(BUCKET).distinct().collect())
    stored_rows = spark.read.option("mergeSchema", True).parquet(path)
    old = stored_rows.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in source.columns if c not in keys])
    joined = old.join(new, keys, "full")
    values = [c for c in [*old.columns, *source.columns] if c not in keys]

    def value(c: str) -> Column:
        found = [F.col(n) for n in (f"_new_{c}", c) if n in joined.columns]
        return F.coalesce(*found).alias(c)

    merged = joined.select(*keys, *[value(c) for c in dict.fromkeys(values)])
    rows = stored(_bucketed(merged, panel, span), "upsert")
    rows = rows.repartition(BUCKET, F.pmod(F.xxhash64(panel.group), F.lit(FILES_PER_BUCKET)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched
