"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.lineage import Rounds


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long); root is the smallest
    node reachable. Alternating large-star and small-star rounds: each is one
    aggregate for the smallest neighbour and one join, so a node with very many
    neighbours is never one list. A round is written, and the one before it is
    removed. Self-loops and repeated edges are allowed."""
    kept = Rounds(edges.sparkSession, "components")
    pairs = kept.put(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _state(pairs)
    while True:
        pairs = kept.put(_small_star(_large_star(pairs)))
        after = _state(pairs)
        if after == state:
            break
        state = after
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    return tuple(
        pairs.select(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
        ).first()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour to the smallest node around."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link each smaller neighbour, and the node itself, to the smallest."""
    pairs = pairs.distinct()
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    linked = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.unionByName(own).where("u <> v").distinct()
