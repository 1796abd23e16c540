"""File sources and sinks: CSV, Parquet, polygons and cell values in JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwright.operators.reshape import sorted_columns
from panelwright.panel import drop_nan


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Give a schema for large files: without one Spark
    reads the data twice to infer it."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return drop_nan(reader.csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(
    spark: SparkSession,
    path: str,
    cols: Sequence[str] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Parquet, all columns or keys and a subset; an empty list means keys only.

    The subset reaches the scan, so other columns are never read.
    """
    df = spark.read.parquet(path)
    if cols is not None:
        df = df.select(*keys, *[c for c in cols if c not in keys])
    return drop_nan(df)


def list_parquet_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the file footers."""
    return spark.read.parquet(path).columns


def write_parquet(
    df: DataFrame, path: str, time: str | None = None, bucket: int | None = None
) -> None:
    """Parquet sink; with a time column and a bucket size the files are
    partitioned by time bucket, so a time filter skips whole folders."""
    writer = df.write.mode("overwrite")
    if time is not None and bucket:
        name = f"{time}_bucket"
        writer = (
            df.withColumn(name, F.floor(F.col(time) / bucket).cast("long"))
            .write.mode("overwrite")
            .partitionBy(name)
        )
    writer.parquet(path)


def read_polygons(
    spark: SparkSession, path: str, id_property: str, one_document: bool = True
) -> DataFrame:
    """GeoJSON features as one row per group: outer vertices, centroid, bounds.

    Polygons and multipolygons are both read; the parts of a multipolygon are
    put together into one vertex list. A document is parsed by one task that
    holds its text and its features at the same time, some three times its
    size; many documents in a folder are read side by side. Without
    `one_document` every line is a collection of its own, which lets Spark
    split a large file.
    """
    ring = "array<array<double>>"
    schema = (
        "features array<struct<"
        f"properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    )
    raw = spark.read.schema(schema).option("multiLine", one_document).json(path)
    feature = raw.select(F.explode("features").alias("f")).select(
        F.col("f.properties")[id_property].cast("long").alias(id_property),
        F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("text"),
    )
    single = F.from_json("text", f"array<{ring}>")
    many = F.from_json("text", f"array<array<{ring}>>")
    outer = F.when(F.col("kind") == "Polygon", F.array(single[0])).otherwise(
        F.transform(many, lambda part: part[0])
    )
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    rings = feature.select(
        id_property, F.transform(outer, lambda r: F.transform(r, point)).alias("rings")
    )
    return rings.select(
        id_property,
        F.flatten("rings").alias("vertices"),
        ring_centroid(F.col("rings")[0]).alias("centroid"),
    ).select(id_property, "vertices", "centroid.x", "centroid.y", *vertex_bounds("vertices"))


def ring_centroid(ring):
    """Area centroid of a closed ring, by the shoelace sums."""
    shifted = F.slice(ring, 2, F.size(ring) - 1)
    edges = F.arrays_zip(
        F.slice(ring, 1, F.size(ring) - 1).alias("a"), shifted.alias("b")
    )
    cross = lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
    total = lambda part: F.aggregate(
        F.transform(edges, part), F.lit(0.0), lambda acc, v: acc + v
    )
    area2 = total(cross)
    sx = total(lambda e: (e["a"]["x"] + e["b"]["x"]) * cross(e))
    sy = total(lambda e: (e["a"]["y"] + e["b"]["y"]) * cross(e))
    return F.struct(
        F.try_divide(sx, area2 * 3).alias("x"), F.try_divide(sy, area2 * 3).alias("y")
    )


def vertex_bounds(vertices: str):
    """Bounds of a vertex list as four columns."""
    xs = F.transform(vertices, lambda p: p["x"])
    ys = F.transform(vertices, lambda p: p["y"])
    return [
        F.array_min(xs).alias("min_x"),
        F.array_max(xs).alias("max_x"),
        F.array_min(ys).alias("min_y"),
        F.array_max(ys).alias("max_y"),
    ]


def read_cells(
    spark: SparkSession, path: str, variable: str, one_document: bool = True
) -> DataFrame:
    """JSON `{"cells": [{"gid", "year", "value"}]}` in long form. What one
    document costs is said at `read_polygons`."""
    schema = "cells array<struct<gid: long, year: int, value: double>>"
    raw = spark.read.schema(schema).option("multiLine", one_document).json(path)
    return (
        raw.select(F.explode("cells").alias("c"))
        .select("c.*")
        .withColumn("variable", F.lit(variable))
    )


def cells_side_by_side(
    long: DataFrame, ids: Sequence[str], variables: Sequence[str]
) -> DataFrame:
    """One column per variable, by one aggregate for all of them."""
    return long.groupBy(*ids).pivot("variable", list(variables)).agg(
        F.first("value", ignorenulls=True)
    )


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write every named table as CSV under a folder."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")


def import_tables(
    spark: SparkSession,
    folder: str,
    ids: Mapping[str, Sequence[str]],
    schemas: Mapping[str, StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """Read exported tables back, keys first. A table that is not there fails
    here and not at its first use."""
    return {
        name: sorted_columns(
            read_csv(spark, f"{folder}/{name}", (schemas or {}).get(name)), list(keys)
        )
        for name, keys in ids.items()
    }
