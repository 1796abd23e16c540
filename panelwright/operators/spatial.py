"""Neighbourhoods and distances between cells.

Neighbourhoods are tables of (group, neighbour) pairs. Distances use a tree of
square buckets over the event points, walked down level by level with joins;
see `nearest_distance`.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.lineage import cut, scratch_folder, stored
from panelwright.panel import Panel

INFINITY = float("inf")


# --- neighbourhoods --------------------------------------------------------


def grid_neighbours(
    cells: DataFrame, id_col: str, row: str, col: str
) -> DataFrame:
    """Queen neighbours on a regular grid: eight offsets and one equi-join."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    offsets = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]
    )
    near = cells.select(F.col(id_col).alias("g"), row, col, F.explode(offsets).alias("o"))
    near = near.select(
        "g", (F.col(row) + F.col("o.i")).alias(row), (F.col(col) + F.col("o.j")).alias(col)
    )
    return near.join(
        cells.select(F.col(id_col).alias("n"), row, col), [row, col]
    ).select("g", "n")


def polygon_neighbours(polygons: DataFrame, id_col: str, vertices: str) -> DataFrame:
    """Cells that share at least one vertex.

    The join is on the vertex. In a map without overlaps only the few cells
    around a corner share it, so the pairs are about as many as the result.
    """
    corners = polygons.select(
        F.col(id_col).alias("g"), F.explode(F.array_distinct(vertices)).alias("v")
    ).select("g", "v.x", "v.y")
    other = corners.select(F.col("g").alias("n"), "x", "y")
    return (
        corners.join(other, ["x", "y"])
        .filter(F.col("g") != F.col("n"))
        .select("g", "n")
        .distinct()
    )


def neighbours_of_order(
    adjacency: DataFrame, first: int = 1, last: int = 1
) -> DataFrame:
    """Pairs whose shortest path has `first` to `last` steps, with its length.

    One join per step; pairs found at an earlier step are taken out. Each ring
    is read three times later on, so its lineage is cut.
    """
    if not 1 <= first <= last:
        raise ValueError("orders run from 1 and must not decrease")
    if last == 1:
        return adjacency.select("g", "n", F.lit(1).alias("order"))
    ring = cut(adjacency.select("g", "n"))
    step = ring.select(F.col("g").alias("n"), F.col("n").alias("next"))
    reached = ring
    found = [ring.withColumn("order", F.lit(1))]
    for order in range(2, last + 1):
        ring = cut(
            ring.join(step, "n")
            .select("g", F.col("next").alias("n"))
            .filter(F.col("g") != F.col("n"))
            .distinct()
            .join(reached, ["g", "n"], "left_anti")
        )
        found.append(ring.withColumn("order", F.lit(order)))
        reached = reached.unionByName(ring)
    out = found[first - 1]
    for frame in found[first:]:
        out = out.unionByName(frame)
    return out


def spatial_sum(
    df: DataFrame, panel: Panel, adjacency: DataFrame, cols: Mapping[str, str]
) -> DataFrame:
    """For each row, sums over the neighbours' rows of the same time.

    A neighbour without a row or value at that time makes the sum missing; a
    cell without neighbours gets 0. Values travel once to every neighbour and
    are combined before the shuffle; all columns share the same two joins.
    """
    g, t = panel.group, panel.time
    degree = adjacency.groupBy("g").agg(F.count(F.lit(1)).alias("_degree"))
    sent = df.select(F.col(g).alias("n"), F.col(t).alias("_t"), *cols).join(
        adjacency.select("g", "n"), "n"
    )
    summed = sent.groupBy("g", "_t").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in cols],
        *[F.count(c).alias(f"_seen_{c}") for c in cols],
    )
    summed = summed.withColumnsRenamed({"g": g, "_t": t})
    joined = df.join(degree.withColumnRenamed("g", g), g, "left").join(
        summed, [t, g], "left"
    )

    def result(c: str) -> Column:
        return F.when(F.col("_degree").isNull(), F.lit(0)).when(
            F.col(f"_seen_{c}") == F.col("_degree"), F.col(f"_sum_{c}")
        )

    return joined.select(*df.columns, *[result(c).alias(out) for c, out in cols.items()])


def spatial_lag(
    df: DataFrame,
    panel: Panel,
    adjacency: DataFrame,
    col: str,
    first: int = 1,
    last: int = 1,
    out: str = "splag",
) -> DataFrame:
    """Unweighted sum over neighbours of order `first` to `last`."""
    pairs = neighbours_of_order(adjacency, first, last).select("g", "n")
    return spatial_sum(df, panel, pairs, {col: out})


def _box_sums(points: DataFrame, time: str, cols: Sequence[str], radii: Sequence[int]) -> DataFrame:
    """(time, _row, _col, {col}_{radius}): sums over the square of each radius
    around every place of the grid, by running sums over the columns of a row and
    then over the rows of a column. The difference of two running sums is the sum
    between them, so a square costs four look-ups whatever its radius."""
    low_r, high_r, low_c, high_c = points.agg(F.min("_row"), F.max("_row"), F.min("_col"), F.max("_col")).first()
    if low_r is None:
        low_r, high_r, low_c, high_c = 0, 0, 0, 0
    # Every place of the grid, so that rows of a window are steps on the grid.
    grid = (
        points.select(time)
        .distinct()
        .select(time, F.explode(F.sequence(F.lit(low_r), F.lit(high_r))).alias("_row"))
        .select(time, "_row", F.explode(F.sequence(F.lit(low_c), F.lit(high_c))).alias("_col"))
    )
    # Laid out by line, for the sums per place and the first window alike.
    placed = (
        points.select(time, "_row", "_col", *cols)
        .unionByName(grid, allowMissingColumns=True)
        .repartition(time, "_row")
        .groupBy(time, "_row", "_col")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    )
    lines = Window.partitionBy(time, "_row").orderBy("_col")
    across = _sliding(placed, lines, {f"{c}_{r}": (c, r) for c in cols for r in radii}, [time, "_row", "_col"])
    columns = Window.partitionBy(time, "_col").orderBy("_row")
    return _sliding(across, columns, {f"{c}_{r}": (f"{c}_{r}", r) for c in cols for r in radii}, [time, "_row", "_col"])


def _sliding(df: DataFrame, line: Window, sums: Mapping[str, tuple[str, int]], keys: Sequence[str]) -> DataFrame:
    """The keys, and for each name the sum of a column from `radius` rows before
    to `radius` rows behind on the line."""
    upto = {c: F.sum(c).over(line.rowsBetween(Window.unboundedPreceding, 0)) for c, _ in sums.values()}
    whole = {c: F.sum(c).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c in upto}
    run = df.select(*keys, *[v.alias(f"_upto_{c}") for c, v in upto.items()], *[v.alias(f"_all_{c}") for c, v in whole.items()])

    def between(c: str, radius: int) -> Column:
        end = F.coalesce(F.lead(f"_upto_{c}", radius).over(line), F.col(f"_all_{c}"))
        return end - F.coalesce(F.lag(f"_upto_{c}", radius + 1).over(line), F.lit(0))

    return run.select(*keys, *[between(c, r).alias(name) for name, (c, r) in sums.items()])


def grid_spatial_sum(
    df: DataFrame, panel: Panel, cells: DataFrame, cols: Mapping[str, str], first: int = 1, last: int = 1,
    row: str = "row", col: str = "col",
) -> DataFrame:
    """`spatial_sum` over the rings `first` to `last` of a regular grid.

    `cells` has (group, row, col), one row per cell. A ring is the square of
    radius `last` without that of radius `first` - 1, taken from summed-area
    tables, so what is shuffled does not depend on the order. A ring cell without
    a row or value at that time makes the sum missing, which a second table of
    counts tells; a cell without ring cells, or not on the grid, gets 0. On a
    grid with holes a ring goes by distance, where `neighbours_of_order` goes by
    steps. The grid is laid out whole for every time, holes too; fractions are
    differences of running sums, right to some 1e-12 of their size.
    """
    if not 1 <= first <= last:
        raise ValueError("orders run from 1 and must not decrease")
    g, t = panel.group, panel.time
    places = cells.select(F.col(g), F.col(row).cast("long").alias("_row"), F.col(col).cast("long").alias("_col"))
    radii = (first - 1, last)
    ring = lambda c: F.col(f"{c}_{last}") - F.col(f"{c}_{first - 1}")
    near = _box_sums(places.withColumns({"_once": F.lit(0), "_cell": F.lit(1)}), "_once", ["_cell"], radii)
    places = places.join(near.select("_row", "_col", ring("_cell").alias("_degree")), ["_row", "_col"])
    names = {c: (f"_sum{i}", f"_seen{i}") for i, c in enumerate(cols)}
    points = df.join(places, g).select(
        F.col(t),
        "_row",
        "_col",
        *[F.col(c).alias(total) for c, (total, _) in names.items()],
        *[F.col(c).isNotNull().cast("long").alias(seen) for c, (_, seen) in names.items()],
    )
    summed = _box_sums(points, t, [n for pair in names.values() for n in pair], radii)
    summed = summed.select(t, "_row", "_col", *[ring(n).alias(n) for pair in names.values() for n in pair])
    joined = df.join(places, g, "left").join(summed, [t, "_row", "_col"], "left")

    def result(c: str) -> Column:
        total, seen = names[c]
        none = F.coalesce("_degree", F.lit(0)) == 0
        return F.when(none, F.lit(0)).when(F.col(seen) == F.col("_degree"), F.col(total))

    return joined.select(*df.columns, *[result(c).alias(out) for c, out in cols.items()])


# --- grids -----------------------------------------------------------------


def coarse_grid(
    spark, rows: int = 180, cols: int = 360, size: float = 1.0, south: float | None = None
) -> DataFrame:
    """A fishnet of square cells from the south-west corner, id 1 first. Its middle
    is at 0 unless the southern edge is given, from where rows go north."""
    south = -rows * size / 2 if south is None else south
    cells = spark.range(rows * cols)
    row = F.floor(F.col("id") / cols)
    col = F.col("id") % cols
    return cells.select(
        (F.col("id") + 1).alias("parent"),
        row.alias("row"),
        col.alias("col"),
        (col * size - cols * size / 2).alias("west"),
        (row * size + south).alias("south"),
    )


# --- nearest events --------------------------------------------------------

# Buckets that every query looks at first, and places that a bucket may hold
# before it is split further; buckets of the first level, over all slices, that
# every task may get; and queries of a task.
FIRST_BUCKETS, LAST_PLACES = 32, 8
SENT_BUCKETS, TASK_QUERIES = 100_000, 20_000


def _tree(points: DataFrame, slices: Sequence[str], dims: Sequence[str], side: float, levels: int, fan: int, origin: Sequence[float]) -> list[DataFrame]:
    """Bucket tables from the root down; the last one holds single points.

    `points` has one row per place with its number `_n`. Every table has the
    bucket number of the level above in `_up_<dim>`, its own in `_at_<dim>`,
    the bounds of its points, their number, and the coordinates of two of them:
    `_early` and `_late`, the least and the largest by the last axis. A point
    counts in a bucket of each level, so all levels come from one aggregate and
    are written together, a folder per level. Of these the walk uses what the
    points call for: it begins with the finest level of at most `FIRST_BUCKETS`
    buckets in any slice, and the points follow on the first level whose buckets
    hold at most `LAST_PLACES` places. Crowded spots keep the finer levels.
    """
    leaf_side = side / fan**levels
    place = F.struct(*[F.col(d).cast("double").alias(d) for d in reversed(dims)])
    leaf = [F.floor((F.col(d) - F.lit(o)) / leaf_side).cast("long") for d, o in zip(dims, origin)]
    bounds = [F.col(d).alias(f"_{e}_{d}") for d in dims for e in ("lo", "hi")]
    shown = [place.alias("_early"), place.alias("_late")]
    width = F.pow(F.lit(float(fan)), F.lit(levels) - F.col("_level"))
    ancestors = points.select(
        "*", *[at.alias(f"_leaf_{d}") for d, at in zip(dims, leaf)],
        F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level"),
    )
    buckets = (
        ancestors.select(
            "_level", *slices, "_n", *shown, *bounds,
            *[F.floor(F.col(f"_leaf_{d}") / width).cast("long").alias(f"_at_{d}") for d in dims],
        )
        .groupBy("_level", *slices, *[f"_at_{d}" for d in dims])
        .agg(
            F.sum("_n").alias("_n"),
            F.count(F.lit(1)).alias("_places"),
            F.min("_early").alias("_early"),
            F.max("_late").alias("_late"),
            *[F.min(f"_lo_{d}").alias(f"_lo_{d}") for d in dims],
            *[F.max(f"_hi_{d}").alias(f"_hi_{d}") for d in dims],
        )
    )
    folder = scratch_folder(points.sparkSession, "buckets")
    buckets.write.partitionBy("_level").parquet(folder)
    read = points.sparkSession.read.schema(buckets.schema).parquet(folder)
    sizes = (
        read.groupBy("_level", *slices)
        .agg(F.count(F.lit(1)).alias("buckets"), F.max("_places").alias("places"))
        .groupBy("_level")
        .agg(F.max("buckets"), F.max("places"), F.sum("buckets"))
        .sort("_level")
        .collect()
    )
    first = max([level for level, number, _, _ in sizes if number <= FIRST_BUCKETS], default=0)
    last = min([level for level, _, places, _ in sizes if places <= LAST_PLACES], default=levels)
    few = sum(total for level, _, _, total in sizes if level == first) <= SENT_BUCKETS

    def table(level: int) -> DataFrame:
        # All buckets of the first level lie in the root, whose number is 0.
        up = [F.floor(F.col(f"_at_{d}") / (fan if level > first else fan ** max(first, 1))) for d in dims]
        rows = read.where(F.col("_level") == level).drop("_level", "_places")
        return rows.select("*", *[u.cast("long").alias(f"_up_{d}") for d, u in zip(dims, up)])

    # A point is its own bucket on the last level, told apart by coordinates.
    above = fan ** (levels - max(first, last))
    up = [F.floor(at / above).cast("long").alias(f"_up_{d}") for d, at in zip(dims, leaf)]
    single = points.select(*slices, "_n", *shown, *up, *bounds)
    # With few slices the first level has few keys, too few to deal queries out by.
    begin = F.broadcast(table(first)) if few else table(first)
    return [begin, *[table(level) for level in range(first + 1, max(first, last) + 1)], single]


def _squared(gaps: Iterable[Column]) -> Column:
    return sum((g * g for g in gaps), F.lit(0.0))


def _walk(
    found: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str], dims: Sequence[str],
    slices: Sequence[str], k: int, causal: str | None,
) -> Iterator[DataFrame]:
    """The buckets that each query keeps, level by level; the last frame has the
    places themselves, with `_near`, their squared distance, and `_n`.

    A query's `_limit` is a squared distance within which k points are certain:
    of a bucket, all its points are within the far corner of its bounds, and the
    two that it shows are where they are. The latter is what keeps the limit
    tight while buckets are still wide.
    """
    ups = [f"_up_{d}" for d in dims]
    per_query = Window.partitionBy(*keys)
    query = {d: F.col(f"_q_{d}") for d in dims}

    for depth, table in enumerate(tables):
        joined = found.join(table, [*slices, *ups])
        gaps, spans = [], []
        for d, q in query.items():
            lo, hi = F.col(f"_lo_{d}"), F.col(f"_hi_{d}")
            if d == causal:
                gaps.append(F.greatest(q - hi, F.lit(0.0)))
                spans.append(q - lo)
            else:
                gaps.append(F.greatest(lo - q, q - hi, F.lit(0.0)))
                spans.append(F.greatest(F.abs(q - lo), F.abs(q - hi)))
        early, late = (
            _squared(q - F.col(f"{shown}.{d}") for d, q in query.items()) for shown in ("_early", "_late")
        )
        sure = F.col("_n")
        if causal is not None:
            q = query[causal]
            joined = joined.filter(F.col(f"_lo_{causal}") <= q)
            # Of a bucket that reaches past the query only the earliest point
            # is sure to count, and it is `q - lo` away on this axis.
            past = F.col(f"_hi_{causal}") <= q
            sure, late = F.when(past, sure).otherwise(F.lit(1)), F.when(past, late)
        joined = joined.withColumns(
            {"_near": _squared(gaps), "_far": _squared(spans), "_seen": F.least(early, late), "_sure": sure}
        ).filter(F.col("_near") <= F.col("_limit"))
        if depth == len(tables) - 1:
            yield joined.select(*keys, "_near", "_n")
            return
        carried = [c for c in found.columns if c not in (*ups, "_limit")]
        downs = [F.col(f"_at_{d}").alias(f"_up_{d}") for d in dims]
        # k points are certain within the far corner of a bucket that has as many,
        # within the farthest corner of all, and among the k nearest shown.
        over = lambda value: F.coalesce(value.over(per_query), F.lit(INFINITY))
        limits = [over(F.min(F.when(F.col("_sure") >= k, F.least("_far", "_seen") if k == 1 else F.col("_far"))))]
        if k > 1:
            joined = joined.withColumn("_place", F.row_number().over(per_query.orderBy("_seen")))
            limits.append(over(F.min(F.when(F.col("_place") >= k, F.col("_seen")))))
            limits.append(F.when(F.sum("_sure").over(per_query) >= k, F.max("_far").over(per_query)))
        bounded = joined.withColumn("_limit", F.least(*limits, "_limit"))
        # Bounds are sums of squares in different order than the distances
        # below them; a hair of slack keeps rounding from dropping a point.
        bounded = bounded.withColumn("_limit", F.col("_limit") * (1 + 1e-12))
        found = bounded.filter(F.col("_near") <= F.col("_limit")).select(*carried, *downs, "_limit")
        yield found


def nearest_distance(
    queries: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    dims: Sequence[str],
    slices: Sequence[str] = (),
    k: int = 1,
    cell: float = 0.5,
    causal: str | None = None,
    out: str = "distance",
) -> DataFrame:
    """Mean distance from each query row to its k nearest points, exactly.

    `keys` identify a query, `slices` are columns that must be equal, `dims`
    are the coordinates on both sides. With `causal`, one of the dims, a point
    only counts when its value there is not above the query's. Queries that
    have fewer than k points are not in the result.

    Buckets of a quad- or octree carry the number and the bounds of their
    points. A query starts at the root and at each level keeps the buckets
    that can still hold one of its k nearest points: those no farther than the
    distance within which k points are certain. That leaves a handful of
    buckets per query at every level whatever the number of points, and the
    last level is the points themselves, so the answer is exact. Points are
    combined by place and written once, as every level is built from them; so
    Spark knows their size, and broadcasts levels while they are small. Larger
    ones are joined on their many distinct bucket numbers.
    """
    # A missing coordinate is no place: such points count for no query, and
    # such queries have no distance.
    queries, points = queries.dropna(subset=list(dims)), points.dropna(subset=list(dims))
    points = stored(points.groupBy(*slices, *dims).agg(F.count(F.lit(1)).alias("_n")), "points")
    extent = points.agg(
        *[F.min(d).alias(f"lo_{d}") for d in dims],
        *[F.max(d).alias(f"hi_{d}") for d in dims],
    ).first()
    if extent[f"lo_{dims[0]}"] is None:
        return queries.select(*keys).limit(0).withColumn(out, F.lit(0.0))
    origin = [float(extent[f"lo_{d}"]) for d in dims]
    widest = max(float(extent[f"hi_{d}"]) - o for d, o in zip(dims, origin))
    # Squares split into 64 smaller ones, cubes too.
    fan = 8 if len(dims) == 2 else 4
    levels = max(1, math.ceil(math.log(max(widest / cell, fan), fan)))
    # Slightly wider than the extent, so that the root bucket has number 0.
    side = cell * fan**levels * 1.0001
    while side <= widest:
        levels, side = levels + 1, side * fan
    tables = _tree(points, slices, dims, side, levels, fan, origin)

    def root_square(q: Column, start: float) -> Column:
        """The query's square on the root level, moved into the only one."""
        square = F.floor((q - F.lit(start)) / side).cast("long")
        return F.greatest(F.least(square, F.lit(0)), F.lit(0))

    query_cols = [*keys, *[c for c in [*slices, *dims] if c not in keys]]
    # A query is a small row that meets many buckets, so that tasks made by bytes
    # would be few and large: they are made by the number of queries.
    session = queries.sparkSession
    tasks = max(
        int(session.conf.get("spark.sql.shuffle.partitions")), math.ceil(queries.count() / TASK_QUERIES)
    )
    queries = queries.select(*query_cols).repartition(tasks, *keys)
    found = queries.select(*query_cols, *[F.col(d).alias(f"_q_{d}") for d in dims])
    found = found.drop(*[d for d in dims if d not in keys])
    found = found.select(
        "*",
        *[root_square(F.col(f"_q_{d}"), o).alias(f"_up_{d}") for d, o in zip(dims, origin)],
        F.lit(INFINITY).alias("_limit"),
    )
    for found in _walk(found, tables, keys, dims, slices, k, causal):
        pass
    per_query = Window.partitionBy(*keys)
    if k == 1:
        return found.groupBy(*keys).agg(F.sqrt(F.min("_near")).alias(out))
    ordered = per_query.orderBy("_near").rowsBetween(Window.unboundedPreceding, 0)
    taken = F.greatest(
        F.least(F.col("_n"), F.lit(k) - (F.col("_cum") - F.col("_n"))), F.lit(0)
    )
    return (
        found.withColumn("_cum", F.sum("_n").over(ordered))
        .withColumn("_take", taken)
        .groupBy(*keys)
        .agg(F.sum(F.sqrt("_near") * F.col("_take")).alias("_sum"), F.sum("_take").alias("_have"))
        .filter(F.col("_have") == k)
        .select(*keys, (F.col("_sum") / F.lit(float(k))).alias(out))
    )


def distance_to_event(
    df: DataFrame,
    panel: Panel,
    col: str,
    x: str,
    y: str,
    k: int = 1,
    fill: float = 99,
    cell: float = 0.5,
    out: str = "spdist",
) -> DataFrame:
    """Mean distance to the k nearest cells that have an event at the time.

    An event is a value of exactly 1. A time without any event gives `fill`, one
    with fewer than k gives infinity.
    """
    events = df.filter(F.col(col) == 1).select(panel.time, x, y)
    return distance_to_points(df, events, panel, x, y, k, fill, cell, out)


def distance_to_points(
    df: DataFrame,
    events: DataFrame,
    panel: Panel,
    x: str,
    y: str,
    k: int = 1,
    fill: float = 99,
    cell: float = 0.5,
    out: str = "distance",
) -> DataFrame:
    """The same over event points of their own, given with time and x, y. A row
    without coordinates has no distance; an event without them is none."""
    events = events.dropna(subset=[x, y])
    placed = F.col(x).isNotNull() & F.col(y).isNotNull()
    dist = nearest_distance(
        df.select(*panel.keys, x, y), events, panel.keys, [x, y], [panel.time], k, cell, out="_dist"
    )
    joined = df.join(dist, panel.keys, "left")
    if k == 1:
        # No distance means that the time has no event.
        value = F.when(placed, F.coalesce("_dist", F.lit(float(fill))))
        return joined.select(*df.columns, value.alias(out))
    per_time = events.groupBy(panel.time).agg(F.count(F.lit(1)).alias("_events"))
    value = F.when(F.col("_events").isNull(), F.lit(float(fill))).otherwise(
        F.coalesce("_dist", F.lit(INFINITY))
    )
    value = F.when(placed, value).alias(out)
    return joined.join(per_time, panel.time, "left").select(*df.columns, value)


def spacetime_distance_to_event(
    df: DataFrame,
    panel: Panel,
    col: str,
    x: str,
    y: str,
    t_scale: float = 1,
    k: int = 1,
    fill: float = 99,
    cell: float = 0.5,
    out: str = "stdist",
) -> DataFrame:
    """Mean distance to the k nearest events in space and past time.

    Time times `t_scale` is a third axis; only events up to the row's time
    count, and there must be more than k of them, else `fill`. For the running
    number of events only the counts per time meet in one task. A row without
    coordinates has no distance and is no event.
    """
    placed = F.col(x).isNotNull() & F.col(y).isNotNull()
    scaled = (F.col(panel.time) * F.lit(float(t_scale))).alias("_z")
    happened = (F.col(col) > 0) & placed
    events = df.filter(happened)
    per_time = df.groupBy(panel.time).agg(F.count(F.when(happened, 1)).alias("_events"))
    past = Window.orderBy(panel.time).rowsBetween(Window.unboundedPreceding, 0)
    so_far = per_time.select(panel.time, F.sum("_events").over(past).alias("_so_far"))
    with_count = df.join(so_far, panel.time)
    queries = with_count.filter(F.col("_so_far") > k).select(*panel.keys, x, y, scaled)
    dist = nearest_distance(
        queries,
        events.select(x, y, scaled),
        panel.keys,
        [x, y, "_z"],
        k=k,
        cell=cell,
        causal="_z",
        out="_dist",
    )
    joined = with_count.join(dist, panel.keys, "left")
    return joined.select(
        *df.columns, F.when(placed, F.coalesce("_dist", F.lit(float(fill)))).alias(out)
    )
