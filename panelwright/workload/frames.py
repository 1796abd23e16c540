"""Panels over the given tables, and the same frames as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import month_id_of, steady_sum
from panelwright.operators.events import count_events
from panelwright.operators.shape import skeleton_between
from panelwright.operators.spatial import grid_neighbours
from panelwright.panel import Panel, Period
from panelwright.workload.base import Tables

PANEL = Panel("t", "g")
FIRST_DAY = "2024-01-01"
GRID_WIDTH = 15

PERIOD_A = Period("A", 0, 9, 10, 14)
PERIOD_B = Period("B", 0, 14, 15, 19)
PERIOD_C = Period("C", 0, 19, 20, 24)


def user_events(tables: Tables) -> DataFrame:
    """Events with user as group and day number as time."""
    return tables.events.select(
        "event_id",
        F.col("user_id").alias("g"),
        F.datediff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).cast("long").alias("t"),
        "event_type",
        "value",
    )


def user_day(tables: Tables) -> DataFrame:
    """Days with events per user. The aggregate combines before its shuffle,
    so one user with a third of all events is only one partial row per task."""
    of = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    return (
        user_events(tables)
        .groupBy("g", "t")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            of("error").alias("n_error"),
            of("purchase").alias("n_purchase"),
            steady_sum("value").alias("value_sum"),
            F.max("value").alias("value_max"),
        )
    )


def days_between(tables: Tables):
    """First and last day number as one scalar subquery on the raw table."""
    day = F.datediff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")).cast("long")
    return tables.events.agg(F.struct(F.min(day).alias("a"), F.max(day).alias("b"))).scalar()


def full_panel(tables: Tables) -> DataFrame:
    """Every user on every day: counts are 0 and values missing in the gaps."""
    days = user_day(tables)
    span = days_between(tables)
    users = tables.events.select(F.col("user_id").alias("g")).distinct()
    rows = skeleton_between(users, PANEL, span["a"], span["b"])
    # The planner takes unfolded rows for as many as there are users, and where a
    # filter turns this into an inner join it would send all of them to every task.
    joined = rows.join(days.hint("merge"), ["g", "t"], "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_events", "n_error", "n_purchase")]
    return joined.select("t", "g", *counts, "value_sum", "value_max")


def nation_month(tables: Tables) -> DataFrame:
    """Orders per nation and month."""
    orders = tables.orders.select(
        "o_custkey", "o_totalprice", "o_orderpriority", month_id_of("o_orderdate").cast("long").alias("t")
    )
    owner = tables.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("g")
    )
    return (
        orders.join(owner, "o_custkey")
        .groupBy("g", "t")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("o_totalprice").alias("total"),
            F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("n_urgent"),
        )
    )


def years_of(tables: Tables) -> list[str]:
    """All years with orders, which become columns: a bounded calendar."""
    span = tables.orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return [] if span[0] is None else [str(y) for y in range(span[0], span[1] + 1)]


def user_cells(tables: Tables) -> DataFrame:
    """Users as cells of a grid, with row, column and centroid."""
    return place_on_grid(tables.events.select(F.col("user_id").alias("g")).distinct())


def place_on_grid(df: DataFrame) -> DataFrame:
    col = F.col("g") % GRID_WIDTH
    row = F.floor(F.col("g") / GRID_WIDTH)
    return df.select(
        "*",
        col.alias("gcol"),
        row.alias("grow"),
        (col + F.lit(0.5)).alias("x"),
        (row + F.lit(0.5)).alias("y"),
    )


def user_adjacency(tables: Tables) -> DataFrame:
    return grid_neighbours(user_cells(tables), "g", "grow", "gcol")


def outcome_frame(tables: Tables) -> DataFrame:
    """Outcomes with predictions that are plain formulas of the panel."""
    value = F.round(F.coalesce("value_sum", F.lit(0.0)), 2)
    n, b = F.col("n_events"), F.col("n_purchase")
    return full_panel(tables).select(
        "t",
        "g",
        F.when(F.col("n_error") > 0, 1).otherwise(0).alias("y"),
        (n / (n + F.lit(2.0))).alias("p_a"),
        (value / (value + F.lit(60.0))).alias("p_b"),
        ((b + F.lit(1.0)) / (n + F.lit(2.0))).alias("p_c"),
        value.alias("v"),
        (n * F.lit(30.0)).alias("f_a"),
        (F.coalesce(F.col("value_max"), F.lit(0.0)) + b).alias("f_b"),
    )


SQL_FRAMES: dict[str, tuple[tuple[str, ...], str]] = {
    "user_events": (
        (),
        """SELECT event_id, user_id AS g,
            CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS t,
            event_type, value FROM events""",
    ),
    "user_day": (
        ("user_events",),
        """SELECT g, t, count(*) AS n_events,
            count(*) FILTER (WHERE event_type = 'error') AS n_error,
            count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
            sum(value) AS value_sum, max(value) AS value_max
            FROM user_events GROUP BY g, t""",
    ),
    "users": ((), "SELECT DISTINCT user_id AS g FROM events"),
    "days": (
        ("user_day",),
        "SELECT unnest(range(min(t), max(t) + 1)) AS t FROM user_day",
    ),
    "full_panel": (
        ("user_day", "users", "days"),
        """SELECT days.t, users.g, coalesce(n_events, 0) AS n_events,
            coalesce(n_error, 0) AS n_error, coalesce(n_purchase, 0) AS n_purchase,
            value_sum, value_max
            FROM users CROSS JOIN days LEFT JOIN user_day
            ON user_day.g = users.g AND user_day.t = days.t""",
    ),
    "nation_month": (
        (),
        """SELECT CAST(c_nationkey AS BIGINT) AS g,
            CAST((year(o_orderdate) - 1980) * 12 + month(o_orderdate) AS BIGINT) AS t,
            count(*) AS n_orders, sum(o_totalprice) AS total,
            count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    ),
    "user_cells": (
        ("users",),
        """SELECT g, g % 15 AS gcol, g // 15 AS grow,
            g % 15 + 0.5 AS x, g // 15 + 0.5 AS y FROM users""",
    ),
    "user_adjacency": (
        ("user_cells",),
        """SELECT a.g, b.g AS n FROM user_cells a JOIN user_cells b
            ON abs(a.gcol - b.gcol) <= 1 AND abs(a.grow - b.grow) <= 1 AND a.g <> b.g""",
    ),
    "outcome_frame": (
        ("full_panel",),
        """SELECT t, g, CASE WHEN n_error > 0 THEN 1 ELSE 0 END AS y,
            n_events / (n_events + 2.0) AS p_a,
            round(coalesce(value_sum, 0.0), 2) / (round(coalesce(value_sum, 0.0), 2) + 60.0) AS p_b,
            (n_purchase + 1.0) / (n_events + 2.0) AS p_c,
            round(coalesce(value_sum, 0.0), 2) AS v,
            CAST(n_events * 30 AS DOUBLE) AS f_a,
            coalesce(value_max, 0.0) + n_purchase AS f_b
            FROM full_panel""",
    ),
}


def with_clause(uses: Sequence[str]) -> str:
    """The WITH clause for the named frames and those they read."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in SQL_FRAMES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in uses:
        visit(name)
    if not ordered:
        return ""
    # Materialised, so that a frame several parts read is computed once.
    parts = [f"{n} AS MATERIALIZED (\n{SQL_FRAMES[n][1]}\n)" for n in ordered]
    return "WITH " + ",\n".join(parts) + "\n"


def count_by_kind(tables: Tables, by: Sequence[str]) -> DataFrame:
    return count_events(
        user_events(tables), by, "event_type", {k: k for k in ("error", "purchase", "view")}, "value"
    )
