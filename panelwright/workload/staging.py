"""Queries for files, stagers, rasters and pages."""

from pyspark.sql import functions as F

from panelwright.functions.scalars import grid_id, month_id_of
from panelwright.functions.windows import tlag
from panelwright.lineage import scratch_folder
from panelwright.operators.shape import skeleton_between
from panelwright.panel import Panel
from panelwright.sources import database as DB
from panelwright.sources import files as FS
from panelwright.sources import pages as PG
from panelwright.sources import raster as RA
from panelwright.sources import stagers as ST
from panelwright.workload.base import query
from panelwright.workload.frames import PANEL, full_panel, nation_month, years_of
from panelwright.workload.gaps import interpolation_sql

# All types of events that occur, and of parts as forms of government.
KINDS = ["click", "error", "purchase", "signup", "view"]
REGIMES = ["economy_plus", "large", "medium", "promo", "small", "standard"]


@query(
    "csv_round_trip",
    ("IO1", "IO2", "IO12"),
    "t:l g:l n_orders:l total:d2",
    "SELECT t, g, n_orders, total FROM nation_month",
    ["nation_month"],
)
def _(t):
    folder = scratch_folder(t.spark, "tables")
    FS.export_tables({"nation_month": nation_month(t)}, folder)
    schema = "g long, t long, n_orders long, total double, n_urgent long"
    return FS.import_tables(
        t.spark, folder, {"nation_month": PANEL.keys}, {"nation_month": schema}
    )["nation_month"]


@query(
    "parquet_round_trip",
    ("IO3", "IO4"),
    "t:l g:l value_max:d listed:l",
    "SELECT t, g, value_max, 8 AS listed FROM full_panel WHERE t BETWEEN 10 AND 19",
    ["full_panel"],
)
def _(t):
    folder = scratch_folder(t.spark, "panel")
    FS.write_parquet(full_panel(t), folder, time="t", bucket=10)
    rows = FS.read_parquet(t.spark, folder, ["value_max", "t_bucket"], PANEL.keys)
    # The bucket is a folder, so the other folders are not opened.
    return rows.filter(F.col("t_bucket") == 1).withColumn(
        "listed", F.lit(len(FS.list_parquet_columns(t.spark, folder)))
    )


@query(
    "table_saved_and_loaded",
    ("IO6", "IO8", "W1"),
    "t:l g:l n_orders:l before:l",
    """SELECT t, g, n_orders, lag(n_orders) OVER (PARTITION BY g ORDER BY t) AS before FROM nation_month""",
    ["nation_month"],
)
def _(t):
    # One name, so that the catalog keeps one entry however often this runs.
    name = "panelwright_saved_panel"
    t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = scratch_folder(t.spark, name)
    DB.save_table(nation_month(t), name, folder, PANEL.group, PANEL.time, buckets=8)
    rows = DB.load_table(t.spark, name, ["n_orders"], PANEL.keys)
    # The table is bucketed by group: this window needs no shuffle.
    return rows.withColumn("before", tlag("n_orders", PANEL))


@query(
    "saved_panel_upserted",
    ("J12", "IO3", "IO4"),
    "t:l g:l n_orders:l total:d2 urgent:l",
    """WITH last AS (SELECT max(t) AS t FROM nation_month)
       SELECT n.t, n.g, CASE WHEN n.t > last.t - 2 AND n.g % 3 <> 0 THEN n_orders + 1000 ELSE n_orders END AS n_orders,
         total, CASE WHEN n.t > last.t - 2 THEN n_urgent END AS urgent
       FROM nation_month n, last""",
    ["nation_month"],
)
def _(t):
    folder = scratch_folder(t.spark, "panel-by-time")
    panel = nation_month(t)
    last = panel.agg(F.max("t")).first()[0]
    new = panel.where(F.col("t") > last - 2)
    DB.save_by_time(panel.where(~((F.col("t") == last) & (F.col("g") == 1))).select("t", "g", "n_orders", "total"), folder, PANEL, span=1)
    changed = F.when(F.col("g") % 3 != 0, F.col("n_orders") + 1000)
    again = new.select("t", "g", changed.alias("n_orders"), "total", F.col("n_urgent").alias("urgent"))
    DB.upsert_by_time(again, folder, PANEL, span=1)
    return t.spark.read.option("mergeSchema", True).parquet(folder)


@query(
    "sql_over_frames",
    "IO7",
    "g:l months:l total:d2",
    "SELECT g, count(*) AS months, sum(total) AS total FROM nation_month WHERE n_urgent > 3 GROUP BY g",
    ["nation_month"],
)
def _(t):
    return DB.query_frames(
        t.spark,
        "SELECT g, count(*) AS months, sum(total) AS total FROM {panel} WHERE n_urgent > 3 GROUP BY g",
        panel=nation_month(t),
    )


@query(
    "columns_split",
    "IO9",
    "part:l t:l g:l name:s value:d",
    " UNION ALL ".join(
        f"SELECT {i // 2} AS part, t, g, '{c}' AS name, CAST({c} AS DOUBLE) AS value FROM full_panel"
        for i, c in enumerate(["n_events", "n_error", "n_purchase", "value_sum", "value_max"])
    ),
    ["full_panel"],
)
def _(t):
    # Written and read part by part; all values are compared.
    frames = []
    for i, p in enumerate(DB.split_columns(full_panel(t), PANEL.keys, 3)):
        folder = scratch_folder(t.spark, f"part-{i}")
        FS.write_parquet(p, folder)
        cells = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in PANEL.values(p)]
        back = t.spark.read.parquet(folder)
        frames.append(back.select(F.lit(i).alias("part"), "t", "g", F.explode(F.array(*cells)).alias("c")).select("part", "t", "g", "c.*"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "polygons_read",
    "IO10",
    "n_nationkey:l corners:l x:d y:d min_x:d max_x:d min_y:d max_y:d",
    """SELECT n_nationkey, 5 AS corners, c + 0.5e0 AS x, r + 0.5e0 AS y, c AS min_x, c + 1 AS max_x, r AS min_y, r + 1 AS max_y
       FROM (SELECT n_nationkey, n_nationkey % 5 AS c, n_nationkey // 5 AS r FROM nation)""",
)
def _(t):
    folder = scratch_folder(t.spark, "polygons")
    c, r = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    ring = F.array(*[F.array((c + i).cast("double"), (r + j).cast("double")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    feature = F.struct(
        F.struct("n_nationkey").alias("properties"),
        F.struct(
            F.lit("Polygon").alias("type"),
            F.array(ring).alias("coordinates"),
        ).alias("geometry"),
    )
    lines = t.nation.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    lines.write.text(folder)
    read = FS.read_polygons(t.spark, folder, "n_nationkey", one_document=False)
    return read.withColumn("corners", F.size("vertices"))


def _nation_features(t):
    """Nations as GeoJSON features, unit squares on a five-wide grid."""
    c, r = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    ring = F.array(*[F.array((c + i).cast("double"), (r + j).cast("double")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return t.nation.select(F.struct(F.struct("n_nationkey").alias("properties"), shape.alias("geometry")).alias("f"))


@query(
    "polygons_of_one_document",
    "IO10",
    "n_nationkey:l x:d y:d",
    "SELECT n_nationkey, n_nationkey % 5 + 0.5e0 AS x, n_nationkey // 5 + 0.5e0 AS y FROM nation",
)
def _(t):
    # The form of real files: a document for each group of at most ten nations.
    folder = scratch_folder(t.spark, "collection")
    part = F.floor(F.col("f.properties.n_nationkey") / 10).alias("part")
    whole = _nation_features(t).groupBy(part).agg(F.collect_list("f").alias("features"))
    json = whole.select(F.to_json(F.struct("features")).alias("value"), "part")
    json.write.partitionBy("part").text(folder)
    return FS.read_polygons(t.spark, f"{folder}/*", "n_nationkey")


@query(
    "cells_of_one_document",
    "IO11",
    "gid:l year:l orders:d",
    "SELECT g AS gid, 1980 + (t - 1) // 12 AS year, sum(n_orders) AS orders FROM nation_month GROUP BY 1, 2",
    ["nation_month"],
)
def _(t):
    # One document with the cells of all years for each group.
    folder = scratch_folder(t.spark, "cells")
    year = (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).cast("int").alias("year")
    cells = nation_month(t).groupBy(F.col("g").alias("gid"), year).agg(F.sum("n_orders").cast("double").alias("value"))
    documents = cells.groupBy("gid").agg(F.collect_list(F.struct("gid", "year", "value")).alias("cells"))
    json = documents.select(F.to_json(F.struct("cells")).alias("value"), "gid")
    json.write.partitionBy("gid").text(folder)
    long = FS.read_cells(t.spark, f"{folder}/*", "orders")
    return FS.cells_side_by_side(long, ["gid", "year"], ["orders"])


@query(
    "yearly_measures_tidied",
    ("PL4", "P3", "P4"),
    "g:l year:l v2_total:d2 v2_orders:d",
    """SELECT g, 1980 + (t - 1) // 12 AS year, sum(total) AS v2_total, sum(n_orders) AS v2_orders FROM nation_month GROUP BY 1, 2""",
    ["nation_month"],
)
def _(t):
    year = (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).alias("Year")
    raw = nation_month(t).groupBy(F.col("g").alias("G"), year).agg(
        F.sum("total").alias("V2.Total"),
        F.stddev("total").alias("V2.Total_sd"),
        F.sum("n_orders").alias("V2.Orders"),
        F.max("n_orders").alias("V2.Orders_codehigh"),
        F.first("g").alias("Project"),
    )
    return ST.yearly_measures(raw, ["project"])


@query(
    "cells_read_side_by_side",
    "IO11",
    "gid:l year:l orders:d urgent:d",
    """SELECT g AS gid, 1980 + (t - 1) // 12 AS year, nullif(sum(n_orders), 0) AS orders,
        CASE WHEN sum(n_urgent) > 20 THEN sum(n_urgent) END AS urgent FROM nation_month GROUP BY 1, 2""",
    ["nation_month"],
)
def _(t):
    yearly = nation_month(t).groupBy(
        F.col("g").alias("gid"), (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).alias("year")
    )
    longs = []
    for name, value in (
        ("orders", F.sum("n_orders")),
        ("urgent", F.when(F.sum("n_urgent") > 20, F.sum("n_urgent"))),
    ):
        folder = scratch_folder(t.spark, name)
        cells = yearly.agg(value.cast("double").alias("value"))
        cells = cells.filter(F.col("value").isNotNull()).select(
            F.struct("gid", "year", "value").alias("cell"), "gid"
        )
        # One document per cell; a real file holds all cells of a variable.
        cells.select(F.to_json(F.struct(F.array("cell").alias("cells"))).alias("value")).write.text(folder)
        longs.append(FS.read_cells(t.spark, folder, name, one_document=False))
    long = longs[0].unionByName(longs[1])
    return FS.cells_side_by_side(long, ["gid", "year"], ["orders", "urgent"])


# --- stagers ---------------------------------------------------------------


@query(
    "coded_source_staged",
    ("PL4", "J9", "P2"),
    "t:l g:l src_orders:l src_total:d2",
    """SELECT s.t, s.g, o.n AS src_orders, o.total AS src_total FROM
        (SELECT DISTINCT m.t, k.g FROM nation_month m CROSS JOIN (SELECT max(c_custkey) AS g FROM customer GROUP BY c_nationkey) k) s
       LEFT JOIN (SELECT m.t, k.g, m.n_orders AS n, m.total FROM nation_month m
         JOIN (SELECT c_nationkey, max(c_custkey) AS g FROM customer GROUP BY 1) k ON k.c_nationkey = m.g) o ON o.t = s.t AND o.g = s.g""",
    ["nation_month"],
)
def _(t):
    # Customers of a nation play the ids a code has had; the newest one counts.
    lookup = t.customer.select(F.col("c_nationkey").cast("long").alias("code"), F.col("c_custkey").alias("g"))
    source = nation_month(t).select(
        "t", F.col("g").alias("code"), F.col("n_orders").alias("orders"), "total"
    )
    newest = lookup.groupBy("code").agg(F.max("g").alias("g")).select("g")
    span = t.orders.agg(
        F.struct(F.min(month_id_of("o_orderdate")).alias("a"), F.max(month_id_of("o_orderdate")).alias("b"))
    ).scalar()
    skeleton = skeleton_between(newest, PANEL, span["a"], span["b"])
    return ST.stage(source, skeleton, ST.Staging(PANEL, "src_", "code", lookup))


SPARSE_TOTALS = interpolation_sql(
    "SELECT t, g, CASE WHEN n_urgent > 5 AND g > 4 THEN total END AS src_total FROM nation_month",
    ["src_total"],
)


@query(
    "filled_source_staged",
    ("PL4", "M2", "M3"),
    "t:l g:l src_total:d",
    f"""SELECT i.t, i.g, coalesce(src_total, m) AS src_total FROM ({SPARSE_TOTALS}) i
       JOIN (SELECT t, avg(src_total) AS m FROM ({SPARSE_TOTALS}) GROUP BY t) q ON q.t = i.t""",
    ["nation_month"],
)
def _(t):
    months = nation_month(t)
    kept = (F.col("n_urgent") > 5) & (F.col("g") > 4)
    source = months.select("t", F.col("g").alias("code"), F.when(kept, F.col("total")).alias("total"))
    lookup = t.nation.select(
        F.col("n_nationkey").cast("long").alias("code"), F.col("n_nationkey").cast("long").alias("g")
    )
    how = ST.Staging(PANEL, "src_", "code", lookup, fill=ST.extrapolated_with_time_means)
    return ST.stage(source, months.select("t", "g"), how)


@query(
    "leaders_staged",
    ("PL4", "P11", "A6", "A7", "F13"),
    "ccode:l year:l month:l tenure_months:l leader:s " + " ".join(f"gov_{r}:l" for r in REGIMES),
    "SELECT ccode, year, month, tenure_months, leader, "
    + ", ".join(f"(government = '{r}')::INT AS gov_{r}" for r in REGIMES)
    + """ FROM (SELECT *, row_number() OVER
         (PARTITION BY ccode, year, month ORDER BY tenure_months NULLS LAST, leader) AS r FROM (
          SELECT CASE WHEN p_size IN (3, 4) THEN 5 ELSE p_size END AS ccode, 2000 + p_partkey % 3 AS year, 1 + p_partkey % 12 AS month,
            CASE WHEN p_partkey % 4 <> 1 THEN CAST(substr(p_brand, 7) AS INT) END AS tenure_months, p_name || p_partkey AS leader,
            CASE WHEN p_type = 'ECONOMY' THEN 'economy_plus' ELSE lower(p_type) END AS government FROM part)) WHERE r = 1""",
)
def _(t):
    kind = F.when(F.col("p_type") == "ECONOMY", F.lit("Economy / Plus")).otherwise(F.col("p_type"))
    rows = t.part.select(
        F.col("p_size").alias("ccode"),
        (F.lit(2000) + F.col("p_partkey") % 3).alias("year"),
        (F.lit(1) + F.col("p_partkey") % 12).alias("month"),
        # Every fourth tenure is missing, so that a missing one must not win.
        F.when(F.col("p_partkey") % 4 != 1, F.substring("p_brand", 7, 9).cast("int")).alias("tenure_months"),
        F.concat("p_name", "p_partkey").alias("leader"),
        kind.alias("government"),
    )
    return ST.leader_months(rows, [(3, 4), (4, 5)], REGIMES)


@query(
    "indicators_staged",
    ("PL4", "A8", "P3"),
    "code:s year:l ny_gdp_total:d2 ny_gdp_count:d",
    """SELECT 'N' || g AS code, 1980 + (t - 1) // 12 AS year, sum(total) AS ny_gdp_total, sum(n_orders) AS ny_gdp_count
       FROM nation_month GROUP BY 1, 2""",
    ["nation_month"],
)
def _(t):
    years = years_of(t)
    pair = F.array(
        F.struct(F.lit("NY.GDP.Total").alias("Indicator Code"), F.col("total").alias("v")),
        F.struct(F.lit("NY.GDP.Count").alias("Indicator Code"), F.col("n_orders").cast("double").alias("v")),
    )
    long = nation_month(t).select(
        F.concat(F.lit("N"), "g").alias("code"),
        (F.lit(1980) + F.floor((F.col("t") - 1) / 12)).cast("string").alias("year"),
        F.explode(pair).alias("i"),
    ).select("code", "year", "i.*")
    wide = long.groupBy("code", "Indicator Code").pivot("year", years).agg(F.sum("v"))
    return ST.indicators_by_year(wide, "code", "Indicator Code", ["NY.GDP.Total", "NY.GDP.Count"])


@query(
    "raster_on_panel",
    ("PL5", "SP2", "J10", "J11", "W13"),
    "t:l g:l " + " ".join(f"{k}:d" for k in KINDS),
    """WITH raster AS (SELECT (t + 529) AS month_id, floor(lat + 90) * 360 + floor(lon + 180) + 1 AS parent, kind, value FROM (
          SELECT t, g // 15 * 0.5e0 AS lat, g % 15 * 0.5e0 AS lon, event_type AS kind, value FROM user_events)),
        coarse AS (SELECT parent, month_id, """
    + ", ".join(f"avg(value) FILTER (kind = '{k}') AS {k}" for k in KINDS)
    + """ FROM raster GROUP BY 1, 2),
        cells AS (SELECT DISTINCT (g // 15 + 180) * 720 + g % 15 + 360 + 1 AS g, floor(g // 15 * 0.5e0 + 90) * 360 + floor(g % 15 * 0.5e0 + 180) + 1 AS parent FROM users)
       SELECT t, g, """
    + ", ".join(f"coalesce(last_value({k} IGNORE NULLS) OVER w, 0) AS {k}" for k in KINDS)
    + """ FROM (SELECT d.t + 529 AS t, c.g, """
    + ", ".join(KINDS)
    + """ FROM cells c CROSS JOIN days d LEFT JOIN coarse k ON k.parent = c.parent AND k.month_id = d.t + 529)
       WINDOW w AS (PARTITION BY g ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ["user_events", "users", "days"],
)
def _(t):
    lat, lon = F.floor(F.col("user_id") / 15) * 0.5, F.col("user_id") % 15 * 0.5
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    # Days stand for months from January 2024 on, which is month 529.
    date = F.add_months(F.lit("2024-01-01").cast("date"), day)
    rows = t.events.select(
        lat.alias("lat"), lon.alias("lon"), date.alias("date"), "event_type", "value", day.alias("day")
    )
    coarse = RA.raster_to_coarse_months(
        rows, "lat", "lon", "date", "event_type", "value", KINDS
    )
    span = rows.agg(F.struct(F.min("day").alias("a"), F.max("day").alias("b"))).scalar()
    cells = rows.select(grid_id("lat", "lon").alias("g")).distinct()
    skeleton = skeleton_between(cells, PANEL, span["a"] + 529, span["b"] + 529)
    return RA.spread_to_panel(skeleton, coarse, PANEL, KINDS)


# --- pages -----------------------------------------------------------------

LINKS = PG.EntryPatterns(
    entry=r"(?s)<li>(.*?)</li>",
    name=r'<a href="/([^"]*)"',
    date=r"<time>(.*?)</time>",
    text=r">([^<]*)</a>",
    flags={"alerts": "ch", "improved": "tion"},
)

LINK_SQL = r"""SELECT page_id, trim(regexp_extract(entry, '<a href="/([^"]*)"', 1)) AS name,
    (contains(entry, 'ch'))::INT AS alerts, (contains(entry, 'tion'))::INT AS improved,
    trim(regexp_extract(entry, '>([^<]*)</a>', 1)) AS text
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)) AS entry FROM pages)"""


@query("page_entries", "PL6", "page_id:l name:s text:s alerts:l improved:l", LINK_SQL)
def _(t):
    return PG.page_entries(t.pages, "html", LINKS, ["page_id"])


def _monthly_links(t):
    entries = PG.page_entries(t.pages, "html", LINKS, ["page_id"])
    cleaned = PG.clean_entries(
        entries, renames=[("the", "of/and"), ("de", "la"), ("la", "que")], drops=["is", "und"]
    )
    date = F.add_months(F.lit("2000-01-01").cast("date"), (F.col("page_id") % 50).cast("int"))
    return PG.entries_per_month(cleaned, date, ["page_id", "text", "alerts", "improved"])


CLEAN_SQL = f"""SELECT page_id, unnest(string_split(CASE part WHEN 'the' THEN 'of/and' WHEN 'de' THEN 'que' WHEN 'la' THEN 'que' ELSE part END, '/')) AS name,
     alerts, improved, text FROM (SELECT *, unnest(string_split(name, '/')) AS part FROM ({LINK_SQL}) WHERE name <> '')"""

MONTHLY_SQL = f"""SELECT * FROM (SELECT 2000 + (page_id % 50) // 12 AS year, 1 + (page_id % 50) % 12 AS month, name, page_id, text, alerts, improved,
     row_number() OVER (PARTITION BY (page_id % 50), name ORDER BY page_id, text, alerts, improved) AS r
     FROM ({CLEAN_SQL}) WHERE name NOT IN ('is', 'und')) WHERE r = 1"""


@query(
    "page_entries_by_month",
    ("PL6", "F14", "P10", "P11", "A7"),
    "year:l month:l name:s page_id:l text:s alerts:l improved:l",
    MONTHLY_SQL,
)
def _(t):
    return _monthly_links(t)


@query(
    "watch_list_panel",
    ("PL6", "M2", "M8"),
    "t:l g:l w_alerts:d w_improved:d w_unobserved:d",
    f"""SELECT t, g, coalesce(alerts, 0) AS w_alerts, coalesce(improved, 0) AS w_improved, coalesce(unobserved, 1) AS w_unobserved FROM (
       {interpolation_sql(f'''SELECT s.t, s.g, e.alerts, e.improved, CASE WHEN e.t IS NOT NULL THEN 0 END AS unobserved FROM
          (SELECT DISTINCT CAST((year - 1980) * 12 + month AS BIGINT) AS t, CAST(n_nationkey AS BIGINT) AS g FROM ({MONTHLY_SQL}) CROSS JOIN nation) s
          LEFT JOIN (SELECT CAST((year - 1980) * 12 + month AS BIGINT) AS t, CAST(length(name) AS BIGINT) AS g, max(alerts) AS alerts, max(improved) AS improved
            FROM ({MONTHLY_SQL}) GROUP BY 1, 2) e ON e.t = s.t AND e.g = s.g''', ['alerts', 'improved', 'unobserved'])})""",
)
def _(t):
    month = (F.col("year") - 1980) * 12 + F.col("month")
    monthly = _monthly_links(t).select(
        month.cast("long").alias("t"), F.length("name").cast("long").alias("g"), "alerts", "improved"
    )
    entries = monthly.groupBy("t", "g").agg(
        F.max("alerts").alias("alerts"), F.max("improved").alias("improved"), F.lit(0).alias("unobserved")
    )
    nations = t.nation.select(F.col("n_nationkey").cast("long").alias("g"))
    span = monthly.agg(F.struct(F.min("t").alias("a"), F.max("t").alias("b"))).scalar()
    skeleton = skeleton_between(nations, PANEL, span["a"], span["b"])
    return ST.watch_list_panel(entries, skeleton, PANEL, ["alerts", "improved"], "w_")


@query(
    "larger_of_two_variants",
    ("A10", "PL4"),
    "c_custkey:l best:d2",
    """SELECT c_custkey, greatest(s, y) AS best FROM (SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN c_acctbal END AS s,
         CASE WHEN c_nationkey < 20 THEN -c_acctbal END AS y FROM customer)""",
)
def _(t):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") > 5, F.col("c_acctbal")).alias("best_s"),
        F.when(F.col("c_nationkey") < 20, -F.col("c_acctbal")).alias("best_y"),
    )
    return ST.greatest_of_variants(rows, {"best": ("best_s", "best_y")})
