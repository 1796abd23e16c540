"""Queries for neighbourhoods, distances and disaggregation."""

import math

from pyspark.sql import functions as F

from panelwright.operators import disaggregate as D
from panelwright.operators import spatial as SP
from panelwright.workload.base import query
from panelwright.workload.frames import (
    PANEL,
    full_panel,
    place_on_grid,
    user_adjacency,
    user_cells,
    user_events,
)


def _nation_polygons(t):
    """Nations as unit squares on a five-wide grid, with their four corners."""
    g = F.col("n_nationkey").cast("long")
    c, r = (g % 5).cast("double"), F.floor(g / 5).cast("double")
    corner = lambda i, j: F.struct((c + i).alias("x"), (r + j).alias("y"))
    return t.nation.select(
        g.alias("g"),
        F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("vertices"),
    )


NATION_PAIRS = """SELECT CAST(a.n_nationkey AS BIGINT) AS g, CAST(b.n_nationkey AS BIGINT) AS n,
    greatest(abs(a.n_nationkey % 5 - b.n_nationkey % 5), abs(a.n_nationkey // 5 - b.n_nationkey // 5)) AS ring
    FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey"""


@query("polygon_neighbours", "SP4", "g:l n:l", f"SELECT g, n FROM ({NATION_PAIRS}) WHERE ring = 1")
def _(t):
    return SP.polygon_neighbours(_nation_polygons(t), "g", "vertices")


@query(
    "neighbours_of_higher_order",
    "SP5",
    "g:l n:l ring:l",
    f"SELECT g, n, ring FROM ({NATION_PAIRS}) WHERE ring BETWEEN 2 AND 3",
)
def _(t):
    adjacency = SP.polygon_neighbours(_nation_polygons(t), "g", "vertices")
    return SP.neighbours_of_order(adjacency, 2, 3).withColumnRenamed("order", "ring")


@query(
    "spatial_lag_first_order",
    "SP3",
    "t:l g:l near_events:l near_value:d",
    """SELECT f.t, f.g, coalesce(sum(b.n_events), 0) AS near_events,
        CASE WHEN count(a.n) = count(b.value_sum) THEN coalesce(sum(b.value_sum), 0) END AS near_value
       FROM full_panel f LEFT JOIN user_adjacency a ON a.g = f.g
       LEFT JOIN full_panel b ON b.g = a.n AND b.t = f.t GROUP BY 1, 2""",
    ["full_panel", "user_adjacency"],
)
def _(t):
    return SP.spatial_sum(
        full_panel(t), PANEL, user_adjacency(t), {"n_events": "near_events", "value_sum": "near_value"}
    )


@query(
    "spatial_lag_second_order",
    ("SP3", "SP5"),
    "t:l g:l splag:l",
    """SELECT f.t, f.g, coalesce(sum(b.n_events), 0) AS splag FROM full_panel f
       LEFT JOIN (SELECT a.g, b.g AS n FROM user_cells a JOIN user_cells b
         ON greatest(abs(a.gcol - b.gcol), abs(a.grow - b.grow)) BETWEEN 1 AND 2) a ON a.g = f.g
       LEFT JOIN full_panel b ON b.g = a.n AND b.t = f.t GROUP BY 1, 2""",
    ["full_panel", "user_cells"],
)
def _(t):
    return SP.spatial_lag(full_panel(t), PANEL, user_adjacency(t), "n_events", 1, 2)


def _ring_sql(first: int, last: int) -> str:
    return f"""SELECT f.t, f.g, coalesce(sum(b.n_events), 0) AS near_events,
        CASE WHEN count(a.n) = count(b.value_sum) THEN coalesce(sum(b.value_sum), 0) END AS near_value
       FROM full_panel f
       LEFT JOIN (SELECT a.g, b.g AS n FROM user_cells a JOIN user_cells b
         ON greatest(abs(a.gcol - b.gcol), abs(a.grow - b.grow)) BETWEEN {first} AND {last}) a ON a.g = f.g
       LEFT JOIN full_panel b ON b.g = a.n AND b.t = f.t GROUP BY 1, 2"""


def _rings_on_grid(first: int, last: int):
    @query(
        f"spatial_lag_on_grid_{first}_{last}",
        ("SP3", "SP5"),
        "t:l g:l near_events:l near_value:d",
        _ring_sql(first, last),
        ["full_panel", "user_cells"],
    )
    def _(t):
        wanted = {"n_events": "near_events", "value_sum": "near_value"}
        return SP.grid_spatial_sum(full_panel(t), PANEL, user_cells(t), wanted, first, last, "grow", "gcol")


for _first, _last in ((1, 1), (1, 2), (3, 5)):
    _rings_on_grid(_first, _last)


def _cells_with_flag(t):
    """The panel with centroids, of which some cells have none, and a 0/1 flag
    that is 1 in a few cells a day."""
    flag = (F.col("n_purchase") >= 3).cast("int")
    x = F.when(F.col("g") % 11 != 3, F.col("x"))
    return place_on_grid(full_panel(t)).withColumns({"flag": flag, "x": x})


FLAGGED = """SELECT f.t, f.g, CASE WHEN f.g % 11 <> 3 THEN c.x END AS x, c.y, (f.n_purchase >= 3)::INT AS flag
    FROM full_panel f JOIN user_cells c ON c.g = f.g"""


def _nearest_sql(k: int, out: str, join: str, time_part: str, enough: str, fill: float) -> str:
    """Brute force: every row against every event it may see."""
    return f"""SELECT t, g, CASE WHEN x IS NULL THEN NULL WHEN NOT {enough} THEN {fill}
          WHEN n < {k} THEN 'infinity'::DOUBLE ELSE {out}_sum / {k} END AS {out}
        FROM (SELECT t, g, x, max(n) AS n, sum(d) FILTER (r <= {k}) AS {out}_sum FROM (
          SELECT a.t, a.g, a.x, sqrt(pow(a.x - e.x, 2) + pow(a.y - e.y, 2) + {time_part}) AS d,
            count(e.g) OVER (PARTITION BY a.t, a.g) AS n,
            row_number() OVER (PARTITION BY a.t, a.g ORDER BY pow(a.x - e.x, 2) + pow(a.y - e.y, 2) + {time_part}) AS r
          FROM ({FLAGGED}) a LEFT JOIN (SELECT * FROM ({FLAGGED}) WHERE flag = 1 AND x IS NOT NULL) e ON {join})
          GROUP BY t, g, x)"""


@query(
    "distance_to_nearest_event",
    "SP6",
    "t:l g:l spdist:d",
    _nearest_sql(1, "spdist", "e.t = a.t", "0", "n > 0", 99),
    ["full_panel", "user_cells"],
)
def _(t):
    return SP.distance_to_event(_cells_with_flag(t), PANEL, "flag", "x", "y", cell=1.0)


@query(
    "distance_to_three_events",
    "SP6",
    "t:l g:l spdist:d",
    _nearest_sql(3, "spdist", "e.t = a.t", "0", "n > 0", 99),
    ["full_panel", "user_cells"],
)
def _(t):
    return SP.distance_to_event(_cells_with_flag(t), PANEL, "flag", "x", "y", k=3, cell=1.0)


@query(
    "spacetime_distance",
    "SP7",
    "t:l g:l stdist:d",
    _nearest_sql(1, "stdist", "e.t <= a.t", "pow(2 * (a.t - e.t), 2)", "n > 1", 99),
    ["full_panel", "user_cells"],
)
def _(t):
    return SP.spacetime_distance_to_event(
        _cells_with_flag(t), PANEL, "flag", "x", "y", t_scale=2, cell=1.0
    )


@query(
    "spacetime_distance_to_three",
    "SP7",
    "t:l g:l stdist:d",
    _nearest_sql(3, "stdist", "e.t <= a.t", "pow(a.t - e.t, 2)", "n > 3", 99),
    ["full_panel", "user_cells"],
)
def _(t):
    return SP.spacetime_distance_to_event(
        _cells_with_flag(t), PANEL, "flag", "x", "y", k=3, cell=1.0
    )


def _event_points(t):
    """Purchases as points near their user's cell."""
    rows = place_on_grid(user_events(t)).filter(F.col("event_type") == "purchase")
    shift = F.col("event_id") % 10 / 10.0
    # Some purchases have no place.
    y = F.when(F.col("event_id") % 7 != 2, F.col("grow") + shift)
    return rows.select("t", (F.col("gcol") + shift).alias("x"), y.alias("y"))


@query(
    "distance_to_event_points",
    "SP8",
    "t:l g:l distance:d",
    """SELECT f.t, f.g, CASE WHEN f.g % 11 <> 3 THEN coalesce(min(sqrt(pow(c.x - e.x, 2) + pow(c.y - e.y, 2))), 99) END AS distance
       FROM full_panel f JOIN user_cells c ON c.g = f.g LEFT JOIN
       (SELECT t, g % 15 + event_id % 10 / 10e0 AS x, g // 15 + event_id % 10 / 10e0 AS y FROM user_events
        WHERE event_type = 'purchase' AND event_id % 7 <> 2) e ON e.t = f.t GROUP BY 1, 2""",
    ["full_panel", "user_cells", "user_events"],
)
def _(t):
    return SP.distance_to_points(
        _cells_with_flag(t), _event_points(t), PANEL, "x", "y", cell=1.0
    ).select("t", "g", "distance")


@query(
    "fishnet_with_users",
    "SP2",
    "parent:l row:l col:l west:d south:d users:l",
    """SELECT (grow + 90) * 360 + gcol + 181 AS parent, grow + 90 AS row, gcol + 180 AS col, gcol AS west, grow AS south,
        count(*) AS users FROM user_cells GROUP BY ALL""",
    ["user_cells"],
)
def _(t):
    # A user's cell on the grid of single degrees, east and north of (0, 0).
    users = user_cells(t).select(((F.col("grow") + 90) * 360 + F.col("gcol") + 181).alias("parent"))
    number = users.groupBy("parent").agg(F.count(F.lit(1)).alias("users"))
    # Many users need more rows than a globe has; they go on to the north.
    last = number.agg(F.max("parent")).first()[0] or 0
    grid = SP.coarse_grid(t.spark, rows=max(180, math.ceil(last / 360)), south=-90.0)
    return number.join(grid, "parent", "left")


# --- events known to an area only -----------------------------------------

AREA_WIDTH = 10


def _area_cells(t):
    return user_cells(t).select(F.floor(F.col("g") / AREA_WIDTH).alias("area"), F.col("g").alias("cell"))


def _vague(t):
    """Sign-ups, taken as known to their area only."""
    return (
        user_events(t)
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("event_id").alias("id"),
            F.floor(F.col("g") / AREA_WIDTH).alias("area"),
            (F.col("event_id") % 3).alias("conflict"),
            F.col("t").alias("month"),
        )
    )


def _exact(t):
    return (
        user_events(t)
        .filter(F.col("event_type") == "error")
        .select(
            F.col("event_id").alias("id"),
            (F.col("event_id") % 3).alias("conflict"),
            F.col("t").alias("month"),
            F.col("g").alias("cell"),
        )
    )


BASE = " + ".join(f"pow(2e0, {-m} / 12e0)" for m in range(13))
UNIFORM = "CAST(concat('0x', substr(md5({0}), 1, 12)) AS BIGINT) / 281474976710656e0"
DRAWN = f"""WITH area_cells AS MATERIALIZED (SELECT g // 10 AS area, g AS cell, row_number() OVER (PARTITION BY g // 10 ORDER BY g) - 1 AS at,
      count(*) OVER (PARTITION BY g // 10) AS cells FROM users),
    vague AS MATERIALIZED (SELECT event_id AS id, g // 10 AS area, event_id % 3 AS conflict, t AS month FROM user_events WHERE event_type = 'signup'),
    exact AS MATERIALIZED (SELECT event_id % 3 AS conflict, t AS month, g AS cell, count(*) * 100 AS density
      FROM user_events WHERE event_type = 'error' GROUP BY 1, 2, 3),
    extra AS MATERIALIZED (SELECT k.conflict, k.month, k.area, a.cell, sum((e.density - 1) * pow(2e0, -(k.month - e.month) / 12e0)) AS extra
      FROM (SELECT DISTINCT conflict, month, area FROM vague) k JOIN area_cells a ON a.area = k.area
      JOIN exact e ON e.cell = a.cell AND e.conflict = k.conflict AND e.month BETWEEN k.month - 12 AND k.month GROUP BY 1, 2, 3, 4),
    laid AS MATERIALIZED (SELECT *, sum(extra) OVER w AS stop, sum(extra) OVER w - extra AS start,
      sum(extra) OVER (PARTITION BY conflict, month, area) AS total FROM extra
      WINDOW w AS (PARTITION BY conflict, month, area ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    draws AS MATERIALIZED (SELECT v.*, d.draw, s.cells, s.cells * ({BASE}) AS base_total,
      {UNIFORM.format("v.id || '|' || d.draw || '|1'")} * (s.cells * ({BASE}) + coalesce(x.total, 0)) AS u
      FROM vague v CROSS JOIN (SELECT unnest(range(1, 16)) AS draw) d
      JOIN (SELECT area, count(*) AS cells FROM area_cells GROUP BY 1) s ON s.area = v.area
      LEFT JOIN (SELECT conflict, month, area, max(total) AS total FROM laid GROUP BY 1, 2, 3) x
        ON x.conflict = v.conflict AND x.month = v.month AND x.area = v.area),
    drawn AS MATERIALIZED (SELECT id, draw, a.cell FROM draws d JOIN area_cells a ON a.area = d.area AND a.at = floor(d.u / ({BASE}))
      WHERE u < base_total
      UNION ALL SELECT id, draw, l.cell FROM draws d JOIN laid l ON l.conflict = d.conflict AND l.month = d.month AND l.area = d.area
        AND d.u - base_total >= l.start AND d.u - base_total < l.stop WHERE u >= base_total)"""


@query(
    "events_drawn_to_cells",
    "SP9",
    "id:l draw:l cell:l",
    f"{DRAWN} SELECT id, draw, cell FROM drawn",
    ["users", "user_events"],
)
def _(t):
    return D.draw_cells(_vague(t), _exact(t), _area_cells(t))


DUMMIES = f"""{DRAWN},
      placed AS (SELECT id, draw, cell FROM drawn UNION SELECT event_id, d.draw, g FROM user_events
        CROSS JOIN (SELECT unnest(range(1, 16)) AS draw) d WHERE event_type = 'error'),
      dated AS (SELECT p.draw, p.cell, e.kind, CAST(e.t + floor({UNIFORM.format("p.id || '|' || p.draw || '|' || e.kind || '|1'")} * 3) AS BIGINT) AS month
        FROM placed p JOIN (SELECT event_id, t, CASE WHEN value < 30 THEN 1 ELSE 2 END AS kind FROM user_events) e ON e.event_id = p.id)
      SELECT draw, cell, month, max((kind = 1)::INT) AS dummy_small, max((kind = 2)::INT) AS dummy_large FROM dated GROUP BY 1, 2, 3"""


@query(
    "imputed_dummies",
    ("SP10", "U1"),
    "draw:l cell:l month:l dummy_small:l dummy_large:l",
    DUMMIES,
    ["users", "user_events"],
)
def _(t):
    return _dummies(t)


def _dummies(t, draws=D.DRAWS):
    events = user_events(t).select(
        F.col("event_id").alias("id"),
        F.when(F.col("value") < 30, 1).otherwise(2).alias("kind"),
        F.col("t").alias("month_start"),
        (F.col("t") + 2).alias("month_end"),
    )
    return D.dummies_of_events(_vague(t), _exact(t), _area_cells(t), events, {"small": 1, "large": 2}, draws)


@query(
    "imputed_dummies_on_skeleton",
    "SP10",
    "t:l g:l dummy_small:l dummy_large:l",
    f"""WITH flags AS ({DUMMIES})
       SELECT f.t, f.g, coalesce(dummy_small, 0) AS dummy_small, coalesce(dummy_large, 0) AS dummy_large
       FROM full_panel f LEFT JOIN flags ON flags.draw = 3 AND flags.cell = f.g AND flags.month = f.t""",
    ["users", "user_events", "full_panel"],
)
def _(t):
    return D.dummies_on_skeleton(full_panel(t).select("t", "g"), _dummies(t, [3]), 3, "g", "t")
