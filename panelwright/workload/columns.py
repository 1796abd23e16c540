"""Queries for projections, predicates and scalar functions."""

from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.functions.windows import onset_possible
from panelwright.operators import events as EV
from panelwright.operators import reshape as R
from panelwright.operators import shape as SH
from panelwright.operators.joins import drop_members, lookup_column
from panelwright.workload.base import query
from panelwright.workload.frames import PANEL, full_panel

# --- projections -----------------------------------------------------------


@query(
    "columns_subset",
    "P1",
    "event_id:l value:d",
    "SELECT event_id, value FROM events",
)
def _(t):
    return R.subset(t.events, ["event_id"], ["value", "not_there"])


@query(
    "columns_prefixed",
    "P2",
    "o_orderkey:l src_o_custkey:l src_total:d2",
    "SELECT o_orderkey, o_custkey AS src_o_custkey, o_totalprice AS src_total FROM orders",
)
def _(t):
    renamed = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("src_total"))
    return R.prefix_columns(renamed, "src_", keep=["o_orderkey"])


@query(
    "columns_tidied",
    "P3",
    "partkey:l part_size:l",
    "SELECT p_partkey AS partkey, p_size AS part_size FROM part",
)
def _(t):
    messy = t.part.select(F.col("p_partkey").alias("Part Key"), F.col("p_size").alias("Part.Size"))
    return R.tidy_columns(messy)


@query(
    "columns_dropped_by_suffix",
    "P4",
    "c_custkey:l balance:d2 kept:s",
    """SELECT c_custkey, c_acctbal AS balance,
        'balance,c_custkey' AS kept FROM customer""",
)
def _(t):
    wide = t.customer.select(
        "c_custkey",
        F.col("c_acctbal").alias("balance"),
        F.col("c_acctbal").alias("balance_sd"),
        F.col("c_nationkey").alias("balance_nr"),
    )
    left = R.drop_by_suffix(wide, ("_sd", "_nr"))
    return left.withColumn("kept", F.lit(",".join(sorted(left.columns))))


@query(
    "columns_totally_missing_dropped",
    "P5",
    "t:l g:l value_max:d kept:l",
    "SELECT t, g, value_max, 3 AS kept FROM full_panel",
    ["full_panel"],
)
def _(t):
    wide = full_panel(t).select(
        "t", "g", "value_max", F.when(F.col("n_events") < 0, F.col("value_max")).alias("empty")
    )
    left = R.drop_totally_missing(wide, PANEL.keys)
    return left.withColumn("kept", F.lit(len(left.columns)))


# --- predicates ------------------------------------------------------------


@query(
    "rows_between_times",
    "P6",
    "t:l g:l n_events:l",
    "SELECT t, g, n_events FROM full_panel WHERE t BETWEEN 5 AND 20",
    ["full_panel"],
)
def _(t):
    return SH.between_times(full_panel(t), "t", 5, 20)


@query(
    "rows_flagged",
    "P7",
    "c_custkey:l n_name:s",
    """SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE n_regionkey = 0""",
)
def _(t):
    flagged = t.nation.withColumn("in_region", (F.col("n_regionkey") == 0).cast("int"))
    joined = t.customer.join(flagged, F.col("c_nationkey") == F.col("n_nationkey"))
    return SH.only_flagged(joined, "in_region")


@query(
    "rows_located_precisely",
    "P8",
    "l_linenumber:l n:l quantity:d2",
    """SELECT l_linenumber, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
       WHERE l_linenumber NOT IN (4, 6, 7) AND l_linenumber < 3 GROUP BY 1""",
)
def _(t):
    kept = EV.only_precise(EV.drop_imprecise(t.lineitem, "l_linenumber"), "l_linenumber")
    return kept.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "rows_without_key_dropped",
    "P9",
    "doc_id:l quality:l",
    "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
def _(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return SH.drop_missing_keys(joined, ["quality"])


@query(
    "rows_named_in_list_dropped",
    "P10",
    "event_id:l event_type:s",
    "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('signup', 'error') AND event_type <> ''",
)
def _(t):
    listed = (
        t.events.select("event_type").distinct().filter(F.col("event_type").isin("signup", "error"))
    )
    named = t.events.filter(F.col("event_type") != "")
    return drop_members(named, listed, ["event_type"])


@query(
    "recode_in_order",
    "P11",
    "c_custkey:l code:l",
    """SELECT c_custkey, CASE WHEN step3 = 5 THEN 6 ELSE step3 END AS code FROM (
         SELECT *, CASE WHEN step2 = 9 THEN 5 ELSE step2 END AS step3 FROM (
           SELECT *, CASE WHEN step1 = 3 THEN 9 ELSE step1 END AS step2 FROM (
             SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN 3 ELSE c_nationkey END AS step1
             FROM customer)))""",
)
def _(t):
    return t.customer.select(
        "c_custkey", S.recode("c_nationkey", [(7, 3), (3, 9), (9, 5), (5, 6)]).alias("code")
    )


WORDS = {
    "battle": "ring",
    "remote": "widget",
    "civilian_event": "gizmo",
    "protest": "bolt",
    "military": "economy",
    "civilians": "brand#1",
}


def _typed_parts(t):
    actor1 = F.when(F.col("p_size") % 10 != 0, F.col("p_type"))
    kind = EV.violence_type(F.col("p_name"), actor1, F.col("p_brand"), WORDS)
    return t.part.withColumn("kind", kind)


TYPED_PARTS = """SELECT *, CASE
    WHEN p_name ILIKE '%bolt%' THEN 4
    WHEN (p_name ILIKE '%ring%' OR p_name ILIKE '%widget%' OR p_name ILIKE '%gizmo%')
         AND actors ILIKE '%brand#1%' THEN 3
    WHEN (p_name ILIKE '%ring%' OR p_name ILIKE '%widget%')
         AND actors NOT ILIKE '%economy%' AND actors NOT ILIKE '%brand#1%' THEN 2
    WHEN (p_name ILIKE '%ring%' OR p_name ILIKE '%widget%')
         AND actors ILIKE '%economy%' AND actors NOT ILIKE '%brand#1%' THEN 1
    END AS kind
    FROM (SELECT *, (CASE WHEN p_size % 10 <> 0 THEN p_type END) || p_brand AS actors FROM part)"""


@query("violence_types", "P12", "p_partkey:l kind:l", f"SELECT p_partkey, kind FROM ({TYPED_PARTS})")
def _(t):
    return _typed_parts(t)


@query(
    "protest_tags",
    "P13",
    "p_partkey:l tag:s",
    f"""SELECT p_partkey, nullif(
          CASE WHEN kind = 4 AND (inter1 = 6 OR inter2 = 6) THEN 'p' ELSE '' END ||
          CASE WHEN kind = 4 AND (inter1 = 5 OR inter2 = 5) THEN 'r' ELSE '' END ||
          CASE WHEN p_name ILIKE '%ring%' AND interaction IN (15, 16, 25, 26, 35, 36, 45, 46) THEN 'x' ELSE '' END ||
          CASE WHEN p_name ILIKE '%ring%' AND interaction IN (15, 16) THEN 'y' ELSE '' END, '') AS tag
        FROM (SELECT *, p_size % 8 AS inter1, p_size % 7 AS inter2, p_size AS interaction FROM ({TYPED_PARTS}))""",
)
def _(t):
    size = F.col("p_size")
    tag = EV.protest_tag(F.col("kind"), size % 8, size % 7, F.col("p_name"), size, "ring")
    return _typed_parts(t).withColumn("tag", tag)


@query(
    "zero_defaults",
    ("P14", "M8"),
    "t:l g:l value_sum:d unobserved:l",
    """SELECT t, g, coalesce(value_sum, 0) AS value_sum,
       coalesce(CASE WHEN value_sum IS NOT NULL THEN 0 END, 1) AS unobserved FROM full_panel""",
    ["full_panel"],
)
def _(t):
    seen = F.when(F.col("value_sum").isNotNull(), F.lit(0))
    return full_panel(t).select(
        "t",
        "g",
        S.one_if_missing(seen).alias("unobserved"),
        S.zero_if_missing("value_sum").alias("value_sum"),
    )


@query(
    "rows_with_possible_onset",
    "P15",
    "t:l g:l n_error:l",
    """SELECT t, g, n_error FROM (
         SELECT *, max(n_error) OVER (PARTITION BY g ORDER BY t ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before
         FROM full_panel) WHERE coalesce(before, 0) = 0""",
    ["full_panel"],
)
def _(t):
    marked = full_panel(t).withColumn("possible", onset_possible("n_error", PANEL, 3))
    return marked.filter(F.col("possible") == 1)


# --- scalar functions ------------------------------------------------------


@query(
    "transform_indicators",
    ("F1", "F2", "F3", "F10"),
    "t:l g:l greq:l smeq:l inside:l inside_strict:l dummy:l",
    """SELECT t, g,
        CASE WHEN value_sum >= 40 THEN 1 ELSE 0 END AS greq,
        CASE WHEN value_sum <= 90 THEN 1 ELSE 0 END AS smeq,
        CASE WHEN value_sum BETWEEN 40 AND 90 THEN 1 ELSE 0 END AS inside,
        CASE WHEN value_sum IS NULL THEN -1 WHEN value_sum BETWEEN 40 AND 90 THEN 1 ELSE 0 END AS inside_strict,
        CASE WHEN n_error > 0 THEN 1 ELSE 0 END AS dummy FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t",
        "g",
        S.greq("value_sum", 40).alias("greq"),
        S.smeq("value_sum", 90).alias("smeq"),
        S.in_range("value_sum", 40, 90).alias("inside"),
        S.in_range("value_sum", 40, 90, strict_compat=True).alias("inside_strict"),
        S.to_dummy("n_error").alias("dummy"),
    )


@query(
    "transform_decay_and_log",
    ("F4", "F5"),
    "t:l g:l decayed:d logged:d",
    """SELECT t, g, pow(2e0, -value_sum / 12e0) AS decayed, ln(1 + value_sum) AS logged FROM full_panel""",
    ["full_panel"],
)
def _(t):
    return full_panel(t).select(
        "t", "g", S.decay("value_sum", 12).alias("decayed"), S.ln("value_sum").alias("logged")
    )


@query(
    "probability_scales",
    ("F6", "F7", "F8", "F9", "F17"),
    "l_orderkey:l l_linenumber:l odds:d logodds:d back:d sigmoid:d clipped:d",
    """SELECT l_orderkey, l_linenumber, p / (1 - p) AS odds, ln(p / (1 - p)) AS logodds,
        (p / (1 - p)) / (p / (1 - p) + 1) AS back, 1 / (1 + exp(-raw)) AS sigmoid, p AS clipped
       FROM (SELECT *, least(greatest(raw, 1e-10), 1 - 1e-10) AS p
             FROM (SELECT l_orderkey, l_linenumber, l_tax * 12.5e0 AS raw FROM lineitem))""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_tax") * 12.5).alias("raw"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        S.prob_to_odds("raw").alias("odds"),
        S.prob_to_logodds("raw").alias("logodds"),
        S.odds_to_prob(S.prob_to_odds("raw")).alias("back"),
        S.logodds_to_prob("raw").alias("sigmoid"),
        S.clip_unit("raw").alias("clipped"),
    )


@query(
    "event_months",
    ("F11", "F12", "J5"),
    "year:l month:l month_id:l n:l",
    """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
        (year(o_orderdate) - 1980) * 12 + month(o_orderdate) AS month_id, count(*) AS n
       FROM orders GROUP BY 1, 2, 3""",
)
def _(t):
    dated = t.orders.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        S.month_id_of("o_orderdate").alias("month_id"),
    )
    return dated.groupBy("year", "month", "month_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "clean_names",
    "F13",
    "o_orderkey:l name:s",
    """SELECT o_orderkey, replace(replace(regexp_replace(lower(o_orderpriority || ' / ' || o_orderstatus),
        '[ \\-/]', '_', 'g'), '__', '_'), '__', '_') AS name FROM orders""",
)
def _(t):
    raw = F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")
    return t.orders.select("o_orderkey", S.clean_name(raw).alias("name"))


@query(
    "split_joined_names",
    "F14",
    "p_partkey:l name:s",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part",
)
def _(t):
    joined = F.replace(F.col("p_name"), F.lit(" "), F.lit("/"))
    return t.part.select("p_partkey", F.explode(S.split_names(joined)).alias("name"))


@query(
    "country_codes_mapped",
    "F15",
    "c_custkey:l region:s",
    """SELECT c_custkey, CASE c_nationkey % 6 WHEN 0 THEN 'AF' WHEN 1 THEN 'AM' WHEN 2 THEN 'AS'
       WHEN 3 THEN 'EU' END AS region FROM customer""",
)
def _(t):
    codes = {0: "AF", 1: "AM", 2: "AS", 3: "EU"}
    return t.customer.select("c_custkey", lookup_column(codes, F.col("c_nationkey") % 6).alias("region"))


@query(
    "clip_to_observed",
    "F16",
    "l_orderkey:l l_linenumber:l l_extendedprice:d2 l_quantity:d2",
    """SELECT l_orderkey, l_linenumber, least(greatest(l_extendedprice, a), b) AS l_extendedprice,
        least(greatest(l_quantity, c), d) AS l_quantity
       FROM lineitem, (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b,
         min(l_quantity) AS c, max(l_quantity) AS d FROM lineitem
         WHERE l_discount > 0.03 AND l_quantity BETWEEN 5 AND 40)""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount"
    )
    observed = rows.filter((F.col("l_discount") > 0.03) & F.col("l_quantity").between(5, 40))
    return R.clip_to_observed(rows, observed, ["l_extendedprice", "l_quantity"])


@query(
    "points_from_text",
    "F18",
    "c_custkey:l x:d y:d",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS x,
        CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS y FROM customer""",
)
def _(t):
    text = F.when(
        F.col("c_custkey") % 5 != 0,
        F.concat(F.lit("POINT("), F.col("c_acctbal"), F.lit(" "), F.col("c_nationkey"), F.lit(")")),
    ).otherwise(F.lit(""))
    return t.customer.select("c_custkey", S.point_from_wkt(text).alias("p")).select(
        "c_custkey", "p.x", "p.y"
    )


@query(
    "row_wise_combinations",
    ("A10", "A11", "A12"),
    "t:l g:l total:d product:d largest:d mean:d",
    """SELECT t, g, coalesce(value_sum, 0) + coalesce(value_max, 0) + n_error AS total,
        coalesce(value_max, 1) * coalesce(rate, 1) AS product,
        greatest(value_max, rate) AS largest,
        CASE WHEN value_max IS NULL AND rate IS NULL THEN NULL
             ELSE (coalesce(value_max, 0) + coalesce(rate, 0)) /
                  ((value_max IS NOT NULL)::INT + (rate IS NOT NULL)::INT) END AS mean
       FROM (SELECT *, CASE WHEN n_error > 0 THEN n_error * 1.5e0 END AS rate FROM full_panel)""",
    ["full_panel"],
)
def _(t):
    rows = full_panel(t).withColumn("rate", F.when(F.col("n_error") > 0, F.col("n_error") * 1.5))
    return rows.select(
        "t",
        "g",
        S.row_sum(["value_sum", "value_max", "n_error"]).alias("total"),
        S.row_product(["value_max", "rate"]).alias("product"),
        S.row_greatest(["value_max", "rate"]).alias("largest"),
        S.row_mean(["value_max", "rate"]).alias("mean"),
    )


@query(
    "grid_cells",
    ("SP1", "SP2", "J10"),
    "event_id:l cell:l parent:l",
    """SELECT event_id, (floor((lat + 90) * 2)) * 720 + floor((lon + 180) * 2) + 1 AS cell,
        floor(lat + 90) * 360 + floor(lon + 180) + 1 AS parent
       FROM (SELECT event_id, (event_id * 37 % 1800) / 10e0 - 90 AS lat,
             (event_id * 53 % 3600) / 10e0 - 180 AS lon FROM events)""",
)
def _(t):
    placed = t.events.select(
        "event_id",
        ((F.col("event_id") * 37 % 1800) / 10.0 - 90).alias("lat"),
        ((F.col("event_id") * 53 % 3600) / 10.0 - 180).alias("lon"),
    )
    cells = placed.select("event_id", S.grid_id("lat", "lon").alias("cell"))
    return cells.withColumn("parent", S.parent_grid_id("cell"))
