"""What the corpus queries share: their register and the splitting of batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CORPUS: dict[str, "CorpusQuery"] = {}

# Characters that one numpy pass works on at most; a longer text is one pass.
PASS_CHARS = 2 << 20


@dataclass(frozen=True)
class CorpusQuery:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def corpus_query(name: str, sql: str | None = None):
    """Register a query that takes (spark, folder), with its SQL twin."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in CORPUS:
            raise ValueError(f"query {name} is declared twice")
        CORPUS[name] = CorpusQuery(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def passes(texts: Sequence[str], limit: int = PASS_CHARS) -> Iterator[slice]:
    """Cut a batch into runs of rows of at most `limit` characters, or one row."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a model of bounded size; the function returned reads it in a
    task, once per task. Classes travel by value, like functions."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)
