"""Queries for aggregation, reshaping, sorting and top-k."""

from pyspark.sql import functions as F

from panelwright.operators import events as EV
from panelwright.operators import reshape as R
from panelwright.operators import shape as SH
from panelwright.operators.ranking import top_k
from panelwright.workload.base import query
from panelwright.workload.frames import (
    PANEL,
    full_panel,
    nation_month,
    user_adjacency,
    user_cells,
    user_day,
    user_events,
    years_of,
)

# All types of events that occur.
KINDS = {k: k for k in ("click", "error", "purchase", "signup", "view")}
# Line numbers of an order, one to seven by the tables' definition.
STEPS = list(range(1, 8))


@query(
    "events_to_panel",
    "A1",
    "t:l g:l " + " ".join(f"count_{k}:l sum_{k}:d" for k in KINDS),
    "SELECT f.t, f.g, "
    + ", ".join(f"coalesce(count_{k}, 0) AS count_{k}, coalesce(sum_{k}, 0) AS sum_{k}" for k in KINDS)
    + " FROM full_panel f LEFT JOIN (SELECT t, g, "
    + ", ".join(
        f"count(*) FILTER (event_type = '{k}') AS count_{k}, sum(value) FILTER (event_type = '{k}') AS sum_{k}"
        for k in KINDS
    )
    + " FROM user_events GROUP BY t, g) k ON k.t = f.t AND k.g = f.g",
    ["full_panel", "user_events"],
)
def _(t):
    return EV.events_to_panel(
        full_panel(t).select("t", "g"), user_events(t), PANEL, "event_type", KINDS, "value"
    )


@query(
    "events_to_region_month",
    "A2",
    "region:l month_id:l count_open:l count_done:l count_part:l sum_open:d2 sum_done:d2 sum_part:d2",
    """SELECT n_regionkey AS region, (year(o_orderdate) - 1980) * 12 + month(o_orderdate) AS month_id,
        count(*) FILTER (o_orderstatus = 'O') AS count_open, count(*) FILTER (o_orderstatus = 'F') AS count_done,
        count(*) FILTER (o_orderstatus = 'P') AS count_part,
        coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 0) AS sum_part,
        coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0) AS sum_open,
        coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0) AS sum_done
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def _(t):
    dated = EV.attach_months(
        t.orders.withColumn("year", F.year("o_orderdate")), "year", "o_orderdate", "o_orderdate"
    ).withColumnRenamed("month_end", "month_id")
    area = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_regionkey").alias("region")
    )
    return EV.count_events(
        dated.join(area, "o_custkey"),
        ["region", "month_id"],
        "o_orderstatus",
        {"open": "O", "done": "F", "part": "P"},
        "o_totalprice",
    )


@query(
    "event_months_with_own_year",
    "A1",
    "month_start:l month_end:l n:l",
    """SELECT (year(l_shipdate) - 1980) * 12 + month(o_orderdate) AS month_start,
        (year(l_shipdate) - 1980) * 12 + month(l_shipdate) AS month_end, count(*) AS n
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def _(t):
    joined = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
    )
    dated = EV.attach_months(
        joined.withColumn("year", F.year("l_shipdate")), "year", "o_orderdate", "l_shipdate"
    )
    return dated.groupBy("month_start", "month_end").agg(F.count(F.lit(1)).alias("n"))


@query(
    "neighbour_counts",
    "A3",
    "t:l g:l n_error:l n_error_lag1:l n_purchase_lag1:l",
    """SELECT f.t, f.g, f.n_error, coalesce(sum(b.n_error), 0) AS n_error_lag1,
        coalesce(sum(b.n_purchase), 0) AS n_purchase_lag1
       FROM full_panel f LEFT JOIN user_adjacency a ON a.g = f.g
       LEFT JOIN full_panel b ON b.g = a.n AND b.t = f.t GROUP BY 1, 2, 3""",
    ["full_panel", "user_adjacency"],
)
def _(t):
    return EV.neighbour_counts(
        full_panel(t), PANEL, user_adjacency(t), ["n_error", "n_purchase"]
    )


@query(
    "conflict_density",
    "A4",
    "conflict:s month:l cell:l density:l",
    """SELECT event_type AS conflict, t AS month, g % 40 AS cell, count(*) * 100 AS density
       FROM user_events GROUP BY 1, 2, 3""",
    ["user_events"],
)
def _(t):
    rows = user_events(t).select(
        F.col("event_type").alias("conflict"), F.col("t").alias("month"), (F.col("g") % 40).alias("cell")
    )
    return EV.grouped_density(rows, "conflict", "month", "cell")


@query(
    "clipped_time_range",
    "A5",
    "first:l last:l",
    "SELECT greatest(-4, min(t)) AS first, least(21, max(t)) AS last FROM user_day",
    ["user_day"],
)
def _(t):
    return EV.clipped_range(user_day(t), "t", -4, 21)


@query(
    "one_hot_priorities",
    "A6",
    "o_orderkey:l pr_1_urgent:l pr_2_high:l pr_3_medium:l pr_4_not_specified:l pr_5_low:l",
    """SELECT o_orderkey, (o_orderpriority = '1-URGENT')::INT AS pr_1_urgent, (o_orderpriority = '2-HIGH')::INT AS pr_2_high,
        (o_orderpriority = '3-MEDIUM')::INT AS pr_3_medium, (o_orderpriority = '4-NOT SPECIFIED')::INT AS pr_4_not_specified,
        (o_orderpriority = '5-LOW')::INT AS pr_5_low FROM orders""",
)
def _(t):
    values = ["1_urgent", "2_high", "3_medium", "4_not_specified", "5_low"]
    return R.one_hot(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "pr", values, tidy=True)


@query(
    "category_rows",
    "A6",
    "o_custkey:l value:s n:l",
    "SELECT o_custkey, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1, 2",
)
def _(t):
    return R.category_rows(t.orders, ["o_custkey"], "o_orderpriority")


@query(
    "first_row_per_key",
    "A7",
    "o_custkey:l year:l o_orderkey:l o_totalprice:d2",
    """SELECT o_custkey, year, o_orderkey, price AS o_totalprice FROM (SELECT *, row_number() OVER (
          PARTITION BY o_custkey, year ORDER BY price NULLS LAST, o_orderkey) AS r
        FROM (SELECT *, year(o_orderdate) AS year, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders))
       WHERE r = 1""",
)
def _(t):
    # Every fifth price is missing, so that a missing value must not win.
    price = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("o_totalprice")
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", price)
    return R.first_per_key(rows, ["o_custkey", "year"], ["o_totalprice", "o_orderkey"])


@query(
    "years_flipped",
    "A8",
    "g:l year:l orders:d total:d2",
    """SELECT g, 1980 + (t - 1) // 12 AS year, nullif(sum(n_orders), 0) AS orders, sum(total) AS total
       FROM nation_month GROUP BY 1, 2""",
    ["nation_month"],
)
def _(t):
    years = years_of(t)
    long = nation_month(t).select(
        "g",
        (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).cast("string").alias("year"),
        F.explode(
            F.array(
                F.struct(F.lit("orders").alias("code"), F.col("n_orders").cast("double").alias("v")),
                F.struct(F.lit("total").alias("code"), F.col("total").alias("v")),
            )
        ).alias("i"),
    ).select("g", "year", "i.*")
    wide = long.groupBy("g", "code").pivot("year", years).agg(F.sum("v"))
    return R.flip_years(wide, ["g"], "code", years, ["orders", "total"])


@query(
    "missing_shares",
    "A9",
    "name:s share_missing:d",
    """SELECT 'value_sum' AS name, avg((value_sum IS NULL)::INT) AS share_missing FROM full_panel
       UNION ALL SELECT 'n_events', avg((n_events IS NULL)::INT) FROM full_panel
       UNION ALL SELECT 'overall', avg((value_sum IS NULL)::INT) / 2 FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return R.missing_profile(full_panel(t), ["value_sum", "n_events"]).withColumnRenamed("column", "name")


@query(
    "bounding_box",
    "A13",
    "min_x:d max_x:d min_y:d max_y:d",
    """SELECT min(x) - 0.5 AS min_x, max(x) + 0.5 AS max_x, min(y) - 0.5 AS min_y, max(y) + 0.5 AS max_y
       FROM user_cells""",
    ["user_cells"],
)
def _(t):
    return R.bounding_box(user_cells(t), "x", "y")


@query(
    "groups_at_last_time",
    "A14",
    "g:l",
    "SELECT DISTINCT g FROM user_day WHERE t = (SELECT max(t) FROM user_day)",
    ["user_day"],
)
def _(t):
    return SH.groups_at_last_time(user_day(t), PANEL)


@query(
    "sorted_panel",
    "S1",
    "t:l g:l n_error:l n_events:l n_purchase:l",
    "SELECT t, g, n_error, n_events, n_purchase FROM user_day",
    ["user_day"],
)
def _(t):
    return R.sort_by_keys(user_day(t), PANEL.keys)


@query(
    "top_parts",
    "S2",
    "l_partkey:l revenue:d2",
    """SELECT l_partkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1
       ORDER BY revenue DESC, l_partkey LIMIT 20""",
)
def _(t):
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    return top_k(t.lineitem.groupBy("l_partkey").agg(revenue), "revenue", 20, ["l_partkey"])


@query(
    "importance_table",
    "S3",
    "feature:s " + " ".join(f"step_{s}:d2" for s in STEPS),
    "SELECT p_brand AS feature, "
    + ", ".join(f"sum(l_extendedprice) FILTER (l_linenumber = {s}) AS step_{s}" for s in STEPS)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY step_1 DESC NULLS LAST, 1 LIMIT 10",
)
def _(t):
    joined = t.lineitem.select("l_partkey", "l_linenumber", "l_extendedprice").join(
        t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("feature")), "l_partkey"
    )
    wide = joined.groupBy("feature").pivot("l_linenumber", STEPS).agg(F.sum("l_extendedprice"))
    return top_k(wide.toDF("feature", *[f"step_{s}" for s in STEPS]), "step_1", 10, ["feature"])


@query(
    "events_on_earth",
    "P6",
    "event_type:s n:l",
    """SELECT event_type, count(*) AS n FROM events WHERE event_id % 400 - 200 BETWEEN -90 AND 90
        AND event_id % 900 - 450 BETWEEN -180 AND 180 GROUP BY 1""",
)
def _(t):
    # Coordinates of which some are not possible.
    lat, lon = F.col("event_id") % 400 - 200, F.col("event_id") % 900 - 450
    return t.events.filter(EV.on_earth(lat, lon)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
