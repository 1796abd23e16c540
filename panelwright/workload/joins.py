"""Queries for joins, lookups and set operations."""

from pyspark.sql import functions as F

from panelwright.functions.scalars import month_id_of
from panelwright.operators import joins as J
from panelwright.operators import reshape as R
from panelwright.operators import shape as SH
from panelwright.panel import Panel
from panelwright.workload.base import query
from panelwright.workload.frames import PANEL, full_panel, nation_month, user_day, user_events


@query(
    "skeleton_left_joins",
    ("J1", "J3", "J4"),
    "t:l g:l n_orders:l n_name:s year_total:d2",
    """SELECT s.t, s.g, n_orders, n_name, year_total FROM
        (SELECT times.t, CAST(n_nationkey AS BIGINT) AS g, 1980 + (times.t - 1) // 12 AS year
         FROM nation CROSS JOIN (SELECT unnest(range(min(t), max(t) + 1)) AS t FROM nation_month) times) s
       LEFT JOIN nation_month m ON m.t = s.t AND m.g = s.g
       LEFT JOIN nation n ON n.n_nationkey = s.g
       LEFT JOIN (SELECT g, 1980 + (t - 1) // 12 AS year, sum(total) AS year_total FROM nation_month GROUP BY 1, 2) y
         ON y.g = s.g AND y.year = s.year""",
    ["nation_month"],
)
def _(t):
    months = nation_month(t)
    year = (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).alias("year")
    span = t.orders.agg(
        F.struct(
            F.min(month_id_of("o_orderdate")).alias("a"), F.max(month_id_of("o_orderdate")).alias("b")
        )
    ).scalar()
    nations = t.nation.select(F.col("n_nationkey").cast("long").alias("g"))
    skeleton = SH.skeleton_between(nations, PANEL, span["a"], span["b"]).select("t", "g", year)
    years = months.groupBy("g", year).agg(F.sum("total").alias("year_total"))
    names = t.nation.select(F.col("n_nationkey").cast("long").alias("g"), "n_name")
    return J.join_tables(
        skeleton, [(months, ["t", "g"]), (names, ["g"]), (years, ["g", "year"])], check=True
    )


@query(
    "lookups_inner",
    "J2",
    "r_name:s month_id:l n:l total:d2",
    """SELECT r_name, (year(o_orderdate) - 1980) * 12 + month(o_orderdate) AS month_id,
        count(*) AS n, sum(o_totalprice) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def _(t):
    joined = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("r_name", month_id_of("o_orderdate").alias("month_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")
    )


@query(
    "update_matching_rows",
    "J6",
    "c_custkey:l c_acctbal:d2",
    """SELECT c.c_custkey, coalesce(big, c_acctbal) AS c_acctbal FROM customer c
       LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS big FROM orders
         WHERE o_orderstatus = 'F' GROUP BY 1) o ON o.o_custkey = c.c_custkey""",
)
def _(t):
    best = (
        t.orders.filter(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("c_acctbal"))
    )
    return J.update_from(t.customer.select("c_custkey", "c_acctbal"), best, ["c_custkey"], ["c_acctbal"])


@query(
    "rows_of_members",
    "J7",
    "o_orderkey:l o_custkey:l",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def _(t):
    members = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return J.only_members(t.orders, members, ["o_custkey"])


@query(
    "keys_not_aligned",
    "J8",
    "t:l g:l",
    """SELECT f.t, f.g FROM full_panel f WHERE NOT EXISTS
       (SELECT 1 FROM user_day u WHERE u.t = f.t AND u.g = f.g)""",
    ["full_panel"],
)
def _(t):
    return J.keys_missing_in(full_panel(t), user_day(t), PANEL.keys)


@query(
    "latest_code_lookup",
    "J9",
    "l_orderkey:l l_linenumber:l p_partkey:l",
    """SELECT l_orderkey, l_linenumber, p.p_partkey FROM lineitem l
       JOIN (SELECT p_size, max(p_partkey) AS p_partkey FROM part GROUP BY 1) p
         ON p.p_size = CAST(l.l_quantity AS INTEGER)""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("p_size")
    )
    return J.join_latest_code(rows, t.part.select("p_size", "p_partkey"), "p_size", "p_partkey")


@query(
    "coarse_values_spread",
    "J11",
    "t:l g:l total:d2",
    """SELECT t, CAST(c_custkey AS BIGINT) AS g, total FROM nation_month m
       JOIN customer c ON c.c_nationkey = m.g""",
    ["nation_month"],
)
def _(t):
    cells = t.customer.select(
        F.col("c_nationkey").cast("long").alias("parent"), F.col("c_custkey").alias("cell")
    )
    coarse = nation_month(t).withColumnRenamed("g", "parent")
    return J.spread_to_fine_cells(coarse, cells, "parent", "cell").withColumnRenamed("cell", "g")


@query(
    "assign_into_panel",
    "J12",
    "t:l g:l value_sum:d n_events:l peak:d",
    """SELECT f.t, f.g, coalesce(u.value_sum, f.value_sum) AS value_sum, f.n_events, u.peak
       FROM (SELECT t, g, CASE WHEN t < 10 THEN value_sum END AS value_sum, n_events FROM full_panel) f
       LEFT JOIN (SELECT t, g, CASE WHEN n_error > 0 THEN value_sum * 2 END AS value_sum,
         value_max AS peak FROM user_day) u ON u.t = f.t AND u.g = f.g""",
    ["full_panel"],
)
def _(t):
    target = full_panel(t).select(
        "t", "g", F.when(F.col("t") < 10, F.col("value_sum")).alias("value_sum"), "n_events"
    )
    source = user_day(t).select(
        "t",
        "g",
        F.when(F.col("n_error") > 0, F.col("value_sum") * 2).alias("value_sum"),
        F.col("value_max").alias("peak"),
    )
    return J.assign_into(target, source, PANEL)


@query(
    "union_of_event_sets",
    "U1",
    "g:l t:l kind:s",
    """SELECT g, t, event_type AS kind FROM user_events WHERE value > 50
       UNION SELECT g, t, event_type FROM user_events WHERE event_type = 'error'""",
    ["user_events"],
)
def _(t):
    rows = user_events(t).withColumnRenamed("event_type", "kind")
    parts = [rows.filter(F.col("value") > 50), rows.filter(F.col("kind") == "error")]
    return R.union_all([p.select("g", "t", "kind") for p in parts], distinct=True)


@query(
    "stacked_periods",
    ("U2", "U3"),
    "t:l g:l n_events:l part:s",
    """SELECT t, g, n_events, 'early' AS part FROM full_panel WHERE t < 8
       UNION ALL SELECT t, g, n_events, NULL FROM full_panel WHERE t BETWEEN 5 AND 12""",
    ["full_panel"],
)
def _(t):
    rows = full_panel(t).select("t", "g", "n_events")
    return R.union_all(
        [rows.filter("t < 8").withColumn("part", F.lit("early")), rows.filter("t between 5 and 12")]
    )


@query(
    "skewed_key_join",
    "J2",
    "event_id:l hot:l label:s",
    """SELECT event_id, hot, CASE WHEN hot = 0 THEN 'big' ELSE 'small' || hot END AS label FROM
       (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS hot FROM events)""",
)
def _(t):
    # A third of the rows on one key: the salted join must give the plain result.
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    rows = t.events.select("event_id", hot.cast("long").alias("hot"))
    labels = rows.select("hot").distinct().withColumn(
        "label",
        F.when(F.col("hot") == 0, F.lit("big")).otherwise(F.concat(F.lit("small"), F.col("hot"))),
    )
    return J.salted_join(rows, labels, ["hot"])
