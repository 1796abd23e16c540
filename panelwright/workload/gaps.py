"""Queries for balancing, interpolation, imputation and resampling."""

from pyspark.sql import functions as F

from panelwright.operators import missing as M
from panelwright.operators import shape as SH
from panelwright.panel import Panel
from panelwright.plans.dataset import Dataset, Table
from panelwright.workload.base import query
from panelwright.workload.frames import PANEL, full_panel, nation_month, user_day

BALANCED = """SELECT times.t, members.g, n_events, value_sum, value_max FROM
    (SELECT DISTINCT t FROM user_day) times
    CROSS JOIN (SELECT DISTINCT g FROM user_day WHERE t = (SELECT max(t) FROM user_day)) members
    LEFT JOIN user_day u ON u.t = times.t AND u.g = members.g"""


def interpolation_sql(source: str, cols, keep: str = "") -> str:
    """Interpolation by row position over a frame with t, g."""
    up = "(PARTITION BY g ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = "(PARTITION BY g ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    marks, outs = [], []
    for c in cols:
        marks += [
            f"last_value({c} IGNORE NULLS) OVER {up} AS {c}_v0",
            f"first_value({c} IGNORE NULLS) OVER {down} AS {c}_v1",
            f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER {up} AS {c}_p0",
            f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER {down} AS {c}_p1",
        ]
        outs.append(
            f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_v0 IS NULL THEN {c}_v1 WHEN {c}_v1 IS NULL THEN {c}_v0
            ELSE {c}_v0 + (CAST({c}_v1 AS DOUBLE) - {c}_v0) * (pos - {c}_p0) / ({c}_p1 - {c}_p0) END AS {c}"""
        )
    return f"""SELECT t, g{keep}, {', '.join(outs)} FROM (SELECT *, {', '.join(marks)} FROM
        (SELECT *, row_number() OVER (PARTITION BY g ORDER BY t) AS pos FROM ({source})))"""


@query(
    "balanced_on_last_time",
    "M1",
    "t:l g:l n_events:l value_sum:d value_max:d",
    BALANCED,
    ["user_day"],
)
def _(t):
    return SH.balance_last_t(user_day(t), PANEL)


@query(
    "interpolated",
    "M2",
    "t:l g:l value_sum:d value_max:d n_error:l",
    interpolation_sql("SELECT * FROM full_panel", ["value_sum", "value_max"], ", n_error"),
    ["full_panel"],
)
def _(t):
    return M.extrapolate(full_panel(t), PANEL, ["value_sum", "value_max"])


SPARSE = """SELECT f.t, f.g, CASE WHEN q.quiet THEN NULL ELSE value_sum END AS value_sum,
    CASE WHEN q.quiet THEN NULL ELSE value_max END AS value_max FROM full_panel f JOIN
    (SELECT g, sum(n_error) <= 10 AS quiet FROM full_panel GROUP BY g) q ON q.g = f.g"""


def _sparse(t):
    """Values of users with few errors are left out altogether."""
    panel = full_panel(t)
    quiet = panel.groupBy("g").agg((F.sum("n_error") <= 10).alias("quiet"))
    joined = panel.join(quiet, "g")
    hide = lambda c: F.when(~F.col("quiet"), F.col(c)).alias(c)
    return joined.select("t", "g", hide("value_sum"), hide("value_max"))


@query(
    "empty_groups_get_time_means",
    "M3",
    "t:l g:l value_sum:d value_max:d",
    f"""SELECT s.t, s.g, CASE WHEN h.has THEN s.value_sum ELSE m.a END AS value_sum,
        CASE WHEN h.has THEN s.value_max ELSE m.b END AS value_max FROM ({SPARSE}) s
       JOIN (SELECT g, bool_or(value_sum IS NOT NULL OR value_max IS NOT NULL) AS has FROM ({SPARSE}) GROUP BY g) h ON h.g = s.g
       JOIN (SELECT t, avg(value_sum) AS a, avg(value_max) AS b FROM ({SPARSE}) GROUP BY t) m ON m.t = s.t""",
    ["full_panel"],
)
def _(t):
    return M.fill_groups_with_time_means(_sparse(t), PANEL)


@query(
    "group_then_global_means",
    "M4",
    "t:l g:l value_sum:d value_max:d",
    f"""WITH first_fill AS (SELECT t, g, coalesce(value_sum, avg(value_sum) OVER (PARTITION BY g)) AS value_sum,
         coalesce(value_max, avg(value_max) OVER (PARTITION BY g)) AS value_max FROM ({SPARSE}))
       SELECT t, g, coalesce(value_sum, (SELECT avg(value_sum) FROM first_fill)) AS value_sum,
        coalesce(value_max, (SELECT avg(value_max) FROM first_fill)) AS value_max FROM first_fill""",
    ["full_panel"],
)
def _(t):
    return M.fill_with_group_and_global_means(_sparse(t), PANEL)


HOLED = """SELECT t, g, value_sum AS s, CASE WHEN g % 4 <> 0 THEN value_max END AS m FROM full_panel"""


def _holed(t):
    """Two columns with gaps of their own; days without events lack both."""
    maximum = F.when(F.col("g") % 4 != 0, F.col("value_max")).alias("m")
    return full_panel(t).select("t", "g", F.col("value_sum").alias("s"), maximum)


def chained_sql(rounds: int) -> str:
    """The rounds as a chain of frames: first s on m, then m on s."""
    parts = [
        f"holed AS MATERIALIZED ({HOLED})",
        """x0 AS MATERIALIZED (SELECT t, g, s IS NULL AS no_s, m IS NULL AS no_m, coalesce(s, avg(s) OVER ()) AS s,
          coalesce(m, avg(m) OVER ()) AS m FROM holed)""",
    ]
    for i in range(2 * rounds):
        y, x = ("s", "m") if i % 2 == 0 else ("m", "s")
        parts.append(
            f"""x{i + 1} AS MATERIALIZED (SELECT t, g, no_s, no_m, {x}, CASE WHEN no_{y} THEN a + b * {x} ELSE {y} END AS {y} FROM x{i},
              (SELECT regr_intercept({y}, {x}) AS a, regr_slope({y}, {x}) AS b FROM x{i} WHERE NOT no_{y}))"""
        )
    bound = lambda c: f"greatest(least({c}, (SELECT max({c}) FROM holed)), (SELECT min({c}) FROM holed)) AS {c}"
    return "WITH " + ",\n".join(parts) + f" SELECT t, g, {bound('s')}, {bound('m')} FROM x{2 * rounds}"


@query("chained_imputation", "M5", "t:l g:l s:d m:d", chained_sql(10), ["full_panel"])
def _(t):
    return M.impute_chained(_holed(t), PANEL, draws=False)


DAY_CLASSES = 31


def wide_chained_sql(rounds: int) -> str:
    """Regression on a column and the classes of days is one slope inside the
    classes around each class's means."""
    parts = [
        f"holed AS MATERIALIZED ({HOLED})",
        """x0 AS MATERIALIZED (SELECT t, g, s IS NULL AS no_s, m IS NULL AS no_m, coalesce(s, avg(s) OVER ()) AS s,
          coalesce(m, avg(m) OVER ()) AS m FROM holed)""",
    ]
    for i in range(2 * rounds):
        y, x = ("s", "m") if i % 2 == 0 else ("m", "s")
        parts.append(
            f"""c{i} AS MATERIALIZED (SELECT t % {DAY_CLASSES} AS c, avg({y}) AS yc, avg({x}) AS xc, regr_sxy({y}, {x}) AS sxy,
              regr_sxx({y}, {x}) AS sxx FROM x{i} WHERE NOT no_{y} GROUP BY 1)"""
        )
        parts.append(
            f"""x{i + 1} AS MATERIALIZED (SELECT t, g, no_s, no_m, {x}, CASE WHEN no_{y} THEN yc + b * ({x} - xc) ELSE {y} END AS {y}
              FROM x{i} JOIN c{i} ON c = t % {DAY_CLASSES}, (SELECT sum(sxy) / sum(sxx) AS b FROM c{i}))"""
        )
    bound = lambda c: f"greatest(least({c}, (SELECT max({c}) FROM holed)), (SELECT min({c}) FROM holed)) AS {c}"
    return "WITH " + ",\n".join(parts) + f" SELECT t, g, {bound('s')}, {bound('m')} FROM x{2 * rounds}"


@query("chained_imputation_of_many_columns", "M5", "t:l g:l s:d m:d", wide_chained_sql(10), ["full_panel"])
def _(t):
    # Thirty columns without gaps, one for each class of days but the last.
    day = F.col("t") % DAY_CLASSES
    classes = [(day == k).cast("double").alias(f"day_{k}") for k in range(DAY_CLASSES - 1)]
    return M.impute_chained(_holed(t).select("*", *classes), PANEL, draws=False).select("t", "g", "s", "m")


@query(
    "tree_imputation",
    ("M5", "M6"),
    "t:l g:l s:d",
    f"""WITH holed AS ({HOLED})
       SELECT t, g, coalesce(s, avg(s) OVER (PARTITION BY t % 7)) AS s FROM holed""",
    ["full_panel"],
)
def _(t):
    # A tree over a column of seven values has a leaf for each.
    rows = _holed(t).select("t", "g", "s", (F.col("t") % 7).cast("double").alias("weekday"))
    return M.impute_chained(rows, PANEL, max_iter=2, estimator="tree").select("t", "g", "s")


@query(
    "imputations_differ",
    "M5",
    "name:s gaps:l inside:l mostly_differ:l",
    f"""WITH holed AS ({HOLED})
       SELECT 's' AS name, count(*) AS gaps, count(*) AS inside, 1 AS mostly_differ FROM holed WHERE s IS NULL
       UNION ALL SELECT 'm', count(*), count(*), 1 FROM holed WHERE m IS NULL""",
    ["full_panel"],
)
def _(t):
    # Two imputations fill every gap within the observed range, and most gaps differently.
    holed = _holed(t)
    first, second = M.imputations(holed, PANEL, 2)
    joined = holed.join(first.toDF("t", "g", "s1", "m1"), ["t", "g"]).join(second.toDF("t", "g", "s2", "m2"), ["t", "g"])
    ranges = holed.agg(F.struct(F.min("s").alias("s0"), F.max("s").alias("s9"), F.min("m").alias("m0"), F.max("m").alias("m9"))).scalar()
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.col(c).isNull().alias("gap"),
                (F.col(f"{c}1").between(ranges[f"{c}0"], ranges[f"{c}9"]) & F.col(f"{c}2").between(ranges[f"{c}0"], ranges[f"{c}9"])).alias("inside"),
                (F.col(f"{c}1") != F.col(f"{c}2")).alias("differ"),
            )
            for c in "sm"
        ]
    )
    return (
        joined.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .filter("gap")
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("gaps"),
            F.sum(F.col("inside").cast("int")).alias("inside"),
            (F.avg(F.col("differ").cast("int")) > 0.5).cast("int").alias("mostly_differ"),
        )
    )


# Some nations have no total at all, which interpolation cannot fill.
YEARLY = """SELECT t, g, CASE WHEN n_urgent > 4 AND g % 6 <> 5 THEN total END AS total, n_orders FROM nation_month"""
INSIDE = interpolation_sql(
    f"""SELECT s.t, s.g, CASE WHEN h.has THEN s.total ELSE m.a END AS total,
      CASE WHEN h.has THEN s.n_orders ELSE m.b END AS n_orders FROM (SELECT * FROM ({YEARLY}) WHERE t BETWEEN 190 AND 240) s
      JOIN (SELECT g, bool_or(total IS NOT NULL OR n_orders IS NOT NULL) AS has FROM ({YEARLY}) WHERE t BETWEEN 190 AND 240 GROUP BY g) h ON h.g = s.g
      JOIN (SELECT t, avg(total) AS a, avg(n_orders) AS b FROM ({YEARLY}) WHERE t BETWEEN 190 AND 240 GROUP BY t) m ON m.t = s.t""",
    ["total", "n_orders"],
)
# Only `total` has gaps left, so that every round has the same fit.
IMPUTED = f"""SELECT i.t, i.g, coalesce(i.total, greatest(least(a + b * i.n_orders, top), low)) AS total, i.n_orders FROM ({INSIDE}) i,
    (SELECT regr_intercept(total, n_orders) AS a, regr_slope(total, n_orders) AS b, max(total) AS top, min(total) AS low
     FROM ({INSIDE}) WHERE total IS NOT NULL)"""


@query(
    "window_filled_then_extrapolated",
    "M6",
    "t:l g:l total:d n_orders:d",
    interpolation_sql(
        f"""SELECT k.t, k.g, w.total, w.n_orders FROM nation_month k LEFT JOIN ({IMPUTED}) w ON w.t = k.t AND w.g = k.g""",
        ["total", "n_orders"],
    ),
    ["nation_month"],
)
def _(t):
    rows = nation_month(t).select(
        "t", "g", F.when((F.col("n_urgent") > 4) & (F.col("g") % 6 != 5), F.col("total")).alias("total"), "n_orders"
    )
    return M.impute_window_extrapolate_rest(rows, PANEL, 190, 240, estimator="linear", draws=False)


@query(
    "carried_then_zero",
    "M7",
    "t:l g:l value_sum:d value_max:d",
    """SELECT t, g, coalesce(last_value(value_sum IGNORE NULLS) OVER (PARTITION BY g ORDER BY t
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS value_sum, coalesce(value_max, 0) AS value_max
       FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return M.forward_fill_then_zero(
        full_panel(t).select("t", "g", "value_sum", "value_max"),
        PANEL,
        ["value_sum"],
        ["value_sum", "value_max"],
    )


def _hash_order(*parts) -> str:
    return "md5(" + " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"


@query(
    "resampled_down",
    "M9",
    "t:l g:l n_error:l",
    f"""SELECT t, g, n_error FROM (SELECT *, row_number() OVER (PARTITION BY n_error = 0 ORDER BY {_hash_order('t', 'g', 1)}) AS r,
         count(*) OVER (PARTITION BY n_error = 0) AS n FROM full_panel)
       WHERE r <= floor(CASE WHEN n_error = 0 THEN 0.1e0 ELSE 0.75e0 END * n)""",
    ["full_panel"],
)
def _(t):
    rows = full_panel(t).select("t", "g", "n_error")
    return M.resample(rows, PANEL.keys, ["n_error"], 0.75, 0.1)


@query(
    "resampled_up",
    "M9",
    "t:l g:l n_error:l copies:l",
    f"""WITH pos AS (SELECT t, g, n_error, row_number() OVER (ORDER BY {_hash_order('t', 'g', 1)}) AS r,
          count(*) OVER () AS n FROM full_panel WHERE n_error <> 0),
        draws AS (SELECT floor(CAST(concat('0x', substr(md5('draw|' || i || '|1'), 1, 12)) AS BIGINT) / 281474976710656e0
          * (SELECT max(n) FROM pos)) + 1 AS r FROM (SELECT unnest(range(CAST(floor(2.5e0 * (SELECT max(n) FROM pos)) AS BIGINT))) AS i))
       SELECT t, g, n_error, count(*) AS copies FROM (
         SELECT t, g, n_error FROM draws JOIN pos ON pos.r = draws.r
         UNION ALL (SELECT t, g, n_error FROM (SELECT *, row_number() OVER (ORDER BY {_hash_order('t', 'g', 1)}) AS r,
           count(*) OVER () AS n FROM full_panel WHERE n_error = 0) WHERE r <= floor(0.5e0 * n)))
       GROUP BY 1, 2, 3""",
    ["full_panel"],
)
def _(t):
    rows = full_panel(t).select("t", "g", "n_error")
    drawn = M.resample(rows, PANEL.keys, ["n_error"], 2.5, 0.5)
    return drawn.groupBy("t", "g", "n_error").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "dataset_built",
    ("PL1", "J1"),
    "t:l g:l n_orders:d quiet_since:l region:d total_lag1:d urgent_share:d",
    f"""SELECT t, g, n_orders, region,
         CASE WHEN prev IS NOT NULL THEN sum(CASE WHEN prev = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g, block ORDER BY t) END AS quiet_since,
         lag(total) OVER (PARTITION BY g ORDER BY t) AS total_lag1, n_urgent * (1 / n_orders) AS urgent_share FROM (
         SELECT *, sum(CASE WHEN prev <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY t) AS block FROM (
           SELECT *, lag(coalesce((n_urgent >= 6)::INT, 0)) OVER (PARTITION BY g ORDER BY t) AS prev FROM (
             {interpolation_sql('''SELECT s.t, s.g, CASE WHEN m.n_orders > 5 THEN m.n_orders END AS n_orders,
                CASE WHEN m.n_orders > 5 THEN m.n_urgent END AS n_urgent, m.total, CAST(n.n_regionkey AS DOUBLE) AS region
                FROM (SELECT a.t, b.g FROM (SELECT DISTINCT t FROM nation_month) a CROSS JOIN
                  (SELECT g FROM nation_month WHERE t = (SELECT max(t) FROM nation_month)) b) s
                LEFT JOIN nation_month m ON m.t = s.t AND m.g = s.g
                LEFT JOIN nation n ON n.n_nationkey = s.g AND m.g IS NOT NULL''',
                ['n_orders', 'n_urgent', 'total', 'region'])})))""",
    ["nation_month"],
)
def _(t):
    months = nation_month(t)
    some = F.col("n_orders") > 5
    counts = months.select(
        "t", "g", F.when(some, F.col("n_orders")).alias("n_orders"), F.when(some, F.col("n_urgent")).alias("n_urgent")
    )
    nations = t.nation.select(
        F.col("n_nationkey").cast("long").alias("g"), F.col("n_regionkey").cast("double").alias("region")
    )
    dataset = Dataset(
        name="orders_by_nation",
        panel=PANEL,
        skeleton=months.select("t", "g"),
        tables=[
            Table("orders.counts", ("t", "g"), counts),
            Table("orders.totals", ("t", "g"), months.select("t", "g", "total")),
            Table("base.nation", ("g",), nations),
        ],
        transforms={
            "busy": {"f": "greq", "col": "n_urgent", "value": 6},
            "quiet_since": {"f": "time_since", "col": "busy"},
            "total_lag1": {"f": "tlag", "col": "total", "time": 1},
        },
        balance=True,
        cols=["n_orders", "n_urgent", "total", "region"],
        check=True,
    )
    return dataset.df().withColumn(
        "urgent_share", F.col("n_urgent") * (F.lit(1.0) / F.col("n_orders"))
    )


@query(
    "cell_skeleton",
    ("PL3", "J3"),
    "t:l cell:l year:l country:l flagged:l",
    """SELECT f.t, f.g AS cell, 2024 + f.t // 12 AS year, o.country, (f.g % 3 = 0)::INT AS flagged FROM full_panel f
       LEFT JOIN (SELECT c_custkey AS cell, c_nationkey AS country, 2024 + c_nationkey % 2 AS year FROM customer) o
         ON o.cell = f.g AND o.year = 2024 + f.t // 12
       WHERE 2024 + f.t // 12 < 2026 AND f.g % 3 = 0""",
    ["full_panel"],
)
def _(t):
    panel = full_panel(t).select("t", F.col("g").alias("cell"))
    calendar = panel.select("t").distinct().withColumn("year", F.lit(2024) + F.floor(F.col("t") / 12))
    owner = t.customer.select(
        F.col("c_custkey").alias("cell"),
        F.col("c_nationkey").alias("country"),
        (F.lit(2024) + F.col("c_nationkey") % 2).cast("long").alias("year"),
    )
    rows = SH.cell_skeleton(panel, calendar, owner, "t", "cell", "year", 2026)
    return SH.only_flagged(rows.withColumn("flagged", (F.col("cell") % 3 == 0).cast("int")), "flagged")
