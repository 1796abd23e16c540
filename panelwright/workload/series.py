"""Queries for time-ordered transforms of a panel."""

from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.functions import windows as W
from panelwright.operators import events as EV
from panelwright.operators import forecast as FC
from panelwright.plans.transforms import apply_transforms
from panelwright.workload.base import query
from panelwright.workload.frames import PANEL, full_panel, nation_month, user_adjacency, user_day

BY_TIME = "OVER (PARTITION BY g ORDER BY t)"


@query(
    "error_memory_by_day",
    ("W7", "F1", "F4", "P14", "J1", "J4"),
    "t:l users:l with_error:l memory:d",
    """SELECT t, count(*) AS users, sum(hit) AS with_error, avg(pow(2e0, -since / 5e0)) AS memory FROM (
         SELECT t, g, hit, CASE WHEN prev IS NOT NULL THEN
           sum(CASE WHEN prev = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g, block ORDER BY t) END AS since
         FROM (SELECT *, sum(CASE WHEN prev <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY t) AS block
           FROM (SELECT t, g, hit, lag(hit) OVER (PARTITION BY g ORDER BY t) AS prev
             FROM (SELECT t, g, CASE WHEN n_error >= 1 THEN 1 ELSE 0 END AS hit FROM full_panel))))
       GROUP BY t""",
    ["full_panel"],
)
def _(t):
    panel = full_panel(t).select("t", "g", S.greq("n_error", 1).alias("hit"))
    since = W.time_since(panel, PANEL, "hit", out="since")
    return since.groupBy("t").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("hit").alias("with_error"),
        F.avg(S.decay("since", 5)).alias("memory"),
    )


@query(
    "transform_lags",
    ("W1", "W2", "W3"),
    "t:l g:l lag1:d lag3:d lead2:d delta:d delta4:l",
    f"""SELECT t, g, lag(value_sum) {BY_TIME} AS lag1, lag(value_sum, 3) {BY_TIME} AS lag3,
        lead(value_sum, 2) {BY_TIME} AS lead2, value_sum - lag(value_sum) {BY_TIME} AS delta,
        n_events - lag(n_events, 4) {BY_TIME} AS delta4 FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.tlag("value_sum", PANEL, 1).alias("lag1"),
        W.tlag("value_sum", PANEL, 3).alias("lag3"),
        W.tlead("value_sum", PANEL, 2).alias("lead2"),
        W.delta("value_sum", PANEL).alias("delta"),
        W.delta("n_events", PANEL, 4).alias("delta4"),
    )


@query(
    "lags_are_positional",
    "W1",
    "t:l g:l lag1:l lag2:l",
    f"SELECT t, g, lag(n_events) {BY_TIME} AS lag1, lag(n_events, 2) {BY_TIME} AS lag2 FROM user_day",
    ["user_day"],
)
def _(t):
    # Gaps in the calendar are skipped: the unbalanced panel keeps positions.
    return user_day(t).select(
        "t", "g", W.tlag("n_events", PANEL, 1).alias("lag1"), W.tlag("n_events", PANEL, 2).alias("lag2")
    )


@query(
    "transform_rolling",
    ("W4", "W5", "W12"),
    "t:l g:l average:d largest:d before:d",
    """SELECT t, g,
        avg(value_sum) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS average,
        max(value_sum) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS largest,
        max(value_sum) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS before
       FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.moving_average("value_sum", PANEL, 6).alias("average"),
        W.rollmax("value_sum", PANEL, 4).alias("largest"),
        W.trailing_max("value_sum", PANEL, 24).alias("before"),
    )


def _spell_sql(source: str, value: str, seed: str | None, out: str) -> str:
    """Gaps and islands: rows of a block share the number of breaks before them."""
    first = f"(SELECT min(t) FROM {source} WHERE x IS NOT NULL)"
    one = f"CASE WHEN t = {first} THEN {seed} ELSE 1 END" if seed else "1"
    return f"""SELECT t, g, CASE WHEN x IS NOT NULL THEN
          sum(CASE WHEN x = {value} THEN {one} ELSE 0 END) OVER (PARTITION BY g, block ORDER BY t) END AS {out}
        FROM (SELECT *, sum(CASE WHEN x <> {value} THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY t) AS block
              FROM {source} WHERE x IS NOT NULL)"""


@query(
    "transform_spells",
    ("W6", "W7"),
    "t:l g:l quiet:l quiet_seeded:l since:l since_seeded:l run_of_two:l",
    f"""WITH err AS (SELECT t, g, n_error AS x FROM full_panel),
        lagged AS (SELECT t, g, lag(n_error) {BY_TIME} AS x FROM full_panel),
        peak AS (SELECT t, g, CASE WHEN value_max > 60 THEN 1 WHEN value_max IS NOT NULL THEN 0 END AS x FROM full_panel)
       SELECT f.t, f.g, a.quiet, b.quiet_seeded, c.since, d.since_seeded, e.run_of_two FROM full_panel f
       LEFT JOIN ({_spell_sql('err', '0', None, 'quiet')}) a ON a.t = f.t AND a.g = f.g
       LEFT JOIN ({_spell_sql('err', '0', '10', 'quiet_seeded')}) b ON b.t = f.t AND b.g = f.g
       LEFT JOIN ({_spell_sql('lagged', '0', None, 'since')}) c ON c.t = f.t AND c.g = f.g
       LEFT JOIN ({_spell_sql('lagged', '0', '7', 'since_seeded')}) d ON d.t = f.t AND d.g = f.g
       LEFT JOIN ({_spell_sql('peak', '1', None, 'run_of_two')}) e ON e.t = f.t AND e.g = f.g""",
    ["full_panel"],
)
def _(t):
    peak = F.when(F.col("value_max") > 60, 1).when(F.col("value_max").isNotNull(), 0)
    panel = full_panel(t).withColumn("peak", peak)
    return W.spell_counts(
        panel,
        PANEL,
        [
            W.Spell("quiet", "n_error"),
            W.Spell("quiet_seeded", "n_error", seed=10),
            W.Spell("since", "n_error", lagged=True),
            W.Spell("since_seeded", "n_error", seed=7, lagged=True),
            W.Spell("run_of_two", "peak", value=1),
        ],
    )


@query(
    "transform_group_means",
    ("W8", "W9"),
    "t:l g:l mean:d demeaned:d",
    """SELECT t, g, avg(value_sum) OVER (PARTITION BY g) AS mean,
        value_sum - avg(value_sum) OVER (PARTITION BY g) AS demeaned FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.group_mean("value_sum", PANEL).alias("mean"),
        W.demean("value_sum", PANEL).alias("demeaned"),
    )


@query(
    "transform_onsets",
    ("W10", "W11"),
    "t:l g:l possible:l started:l started_value:l",
    """SELECT t, g, (coalesce(e, 0) = 0)::INT AS possible, (coalesce(e, 0) = 0 AND n_error <> 0)::INT AS started,
        (coalesce(v, 0) = 0 AND coalesce(value_sum <> 0, true))::INT AS started_value FROM (
         SELECT *, max(n_error) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS e,
          max(coalesce(value_sum, 0)) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS v
         FROM full_panel)""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.onset_possible("n_error", PANEL, 4).alias("possible"),
        W.onset("n_error", PANEL, 4).alias("started"),
        W.onset("value_sum", PANEL, 1).alias("started_value"),
    )


@query(
    "carry_forward",
    ("W13", "W14"),
    "t:l g:l carried:d carried_or_zero:d",
    """SELECT t, g, last_value(value_sum IGNORE NULLS) OVER w AS carried,
        coalesce(last_value(value_sum IGNORE NULLS) OVER w, 0) AS carried_or_zero FROM full_panel
       WINDOW w AS (PARTITION BY g ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.forward_fill("value_sum", PANEL).alias("carried"),
        W.forward_fill_or("value_sum", PANEL).alias("carried_or_zero"),
    )


@query(
    "since_last_event",
    ("W15", "W17"),
    "t:l g:l since:l since_50:l since_100:l distance:l",
    """SELECT t, g, t - max(CASE WHEN n_error > 0 THEN t END) OVER w AS since,
        t - max(CASE WHEN value_sum >= 50 THEN t END) OVER w AS since_50,
        t - max(CASE WHEN value_sum >= 100 THEN t END) OVER w AS since_100,
        CASE WHEN n_error > 0 THEN t - max(CASE WHEN n_error > 0 THEN t END) OVER
          (PARTITION BY g ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS distance
       FROM full_panel WINDOW w AS (PARTITION BY g ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        W.since_last_event("n_error", PANEL).alias("since"),
        W.since_last_event("value_sum", PANEL, 50).alias("since_50"),
        W.since_last_event("value_sum", PANEL, 100).alias("since_100"),
        W.onset_distance("n_error", PANEL).alias("distance"),
    )


LAGGED = ("n_events", "n_error", "value_sum")


@query(
    "lag_bank",
    "W16",
    "t:l g:l "
    + " ".join(f"{c}_tlag{k}:{'d' if c == 'value_sum' else 'l'}" for c in LAGGED for k in range(1, 13)),
    "SELECT t, g, "
    + ", ".join(f"lag({c}, {k}) {BY_TIME} AS {c}_tlag{k}" for c in LAGGED for k in range(1, 13))
    + " FROM full_panel",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select("t", "g", *W.lag_bank(LAGGED, PANEL, range(1, 13)))


@query(
    "onset_in_quiet_neighbourhood",
    "W18",
    "t:l g:l onset_quiet:l",
    """SELECT m.t, m.g, (m.started = 1 AND coalesce(q.busy, 0) = 0)::INT AS onset_quiet FROM (
         SELECT t, g, (coalesce(e, 0) = 0 AND n_purchase <> 0)::INT AS started FROM (SELECT *,
          max(n_purchase) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS e FROM full_panel)) m
       LEFT JOIN (SELECT a.g, b.t, sum((coalesce(b.e, 0) <> 0)::INT) AS busy FROM user_adjacency a JOIN
         (SELECT *, max(n_purchase) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS e
          FROM full_panel) b ON b.g = a.n GROUP BY 1, 2) q ON q.g = m.g AND q.t = m.t""",
    ["full_panel", "user_adjacency"],
)
def _(t):
    return EV.onset_in_quiet_neighbourhood(
        full_panel(t), PANEL, user_adjacency(t), "n_purchase", 2
    )


@query(
    "features_shifted",
    "W19",
    "t:l g:l n_events:l value_max:d n_error:l",
    f"""SELECT t, g, lag(n_events, 3) {BY_TIME} AS n_events, lag(value_max, 3) {BY_TIME} AS value_max, n_error
       FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return FC.shift_features(
        full_panel(t), PANEL, ["n_events", "value_max"], 3, [F.col("n_error")]
    )


@query(
    "named_transforms",
    "PL2",
    "t:l g:l hit:l since:l memory:d ln_total:d smooth:d combined:d near:l mean:d",
    f"""SELECT p.*, n.near FROM (
         SELECT t, g, hit, since, pow(2e0, -since / 12e0) AS memory, ln(1 + total) AS ln_total,
          avg(ln(1 + total)) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS smooth,
          hit + coalesce(ln(1 + total), 0) AS combined, avg(hit) OVER (PARTITION BY g) AS mean
         FROM (SELECT *, CASE WHEN prev IS NOT NULL THEN
             sum(CASE WHEN prev = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g, block ORDER BY t) END AS since
           FROM (SELECT *, sum(CASE WHEN prev <> 0 THEN 1 ELSE 0 END) {BY_TIME} AS block
             FROM (SELECT *, lag(hit) {BY_TIME} AS prev FROM (SELECT t, g, (total >= 4000000)::INT AS hit, total
               FROM nation_month))))) p
       JOIN (SELECT a.t, a.g, CASE WHEN count(*) = count(b.g) THEN sum((b.total >= 4000000)::INT) END AS near
         FROM nation_month a JOIN nation c
         ON a.g <> c.n_nationkey AND abs(a.g % 5 - c.n_nationkey % 5) <= 1 AND abs(a.g // 5 - c.n_nationkey // 5) <= 1
         LEFT JOIN nation_month b ON b.t = a.t AND b.g = c.n_nationkey GROUP BY 1, 2) n ON n.t = p.t AND n.g = p.g""",
    ["nation_month"],
)
def _(t):
    from panelwright.operators.spatial import grid_neighbours
    from panelwright.plans.transforms import Space

    g = F.col("g")
    panel = nation_month(t)
    cells = t.nation.select(F.col("n_nationkey").cast("long").alias("g")).select(
        "g", (g % 5).alias("gc"), F.floor(g / 5).alias("gr")
    )
    # Declared in no particular order: each reads columns that others make.
    specs = {
        "smooth": {"f": "moving_average", "col": "ln_total", "time": 3},
        "memory": {"f": "decay", "col": "since", "halflife": 12},
        "since": {"f": "time_since", "col": "hit"},
        "near": {"f": "splag", "col": "hit"},
        "hit": {"f": "greq", "col": "total", "value": 4000000},
        "ln_total": {"f": "ln", "col": "total"},
        "combined": {"f": "sum", "cols": ["hit", "ln_total"]},
        "mean": {"f": "mean", "col": "hit"},
    }
    return apply_transforms(panel, PANEL, specs, Space(grid_neighbours(cells, "g", "gr", "gc")))
