"""How queries over the given tables are declared and finished."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, "Query"] = {}

# Output types: whole number, text, and doubles rounded to some places.
PLACES = {"d": 6, "d4": 4, "d2": 2}


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    cols: Mapping[str, str]
    build: Callable[["Tables"], DataFrame]
    body: str | None
    uses: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Tables(spark, folder))
        return df.select(*[_spark_column(c, kind) for c, kind in self.cols.items()])

    def sql(self) -> str | None:
        if self.body is None:
            return None
        from panelwright.workload.frames import with_clause

        outputs = ", ".join(_sql_column(c, kind) for c, kind in self.cols.items())
        return f"{with_clause(self.uses)}SELECT {outputs} FROM (\n{self.body.strip()}\n) AS result"


class Tables:
    """The given tables of a folder, each read when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _spark_column(name: str, kind: str):
    c = F.col(name)
    if kind == "l":
        return c.cast("long").alias(name)
    if kind == "s":
        return c.cast("string").alias(name)
    # Adding zero makes a rounded negative zero positive.
    return (F.round(c.cast("double"), PLACES[kind]) + F.lit(0.0)).alias(name)


def _sql_column(name: str, kind: str) -> str:
    if kind == "l":
        return f"CAST({name} AS BIGINT) AS {name}"
    if kind == "s":
        return f"CAST({name} AS VARCHAR) AS {name}"
    return f"round(CAST({name} AS DOUBLE), {PLACES[kind]}) + 0.0 AS {name}"


def query(
    name: str,
    covers: str | Sequence[str],
    cols: str,
    sql: str | None = None,
    uses: Sequence[str] = (),
):
    """Register a query. `cols` lists `column:type` pairs, `uses` the shared
    frames that the SQL text refers to."""
    typed = dict(c.split(":") for c in cols.split())

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is declared twice")
        ids = (covers,) if isinstance(covers, str) else tuple(covers)
        REGISTRY[name] = Query(name, ids, typed, build, sql, tuple(uses))
        return build

    return register
