"""Placing events that are only known to an area into its cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.lineage import stored
from panelwright.operators.events import grouped_density
from panelwright.operators.joins import salted_join
from panelwright.operators.ranking import uniform

# Draws per event, months looked back, months that halve a
# density, weight of a cell-month without events.
DRAWS = 15
MONTHS_BACK = 12
HALFLIFE = 12.0
EMPTY_DENSITY = 1.0

# Draws whose flags share a number, a bit each.
WORD = 32

BASE_WEIGHT = EMPTY_DENSITY * sum(2 ** (-m / HALFLIFE) for m in range(MONTHS_BACK + 1))


def extra_weights(exact: DataFrame) -> DataFrame:
    """What a cell's recent events add to the weight of an empty cell.

    `exact` has conflict, month and cell. Each density row unfolds into the
    thirteen months it still counts in, so looking back over months is an
    aggregate and not a range join.
    """
    density = grouped_density(exact, "conflict", "month", "cell")
    ahead = density.select(
        "conflict",
        "cell",
        "month",
        "density",
        F.explode(F.sequence(F.lit(0), F.lit(MONTHS_BACK))).alias("age"),
    )
    added = (F.col("density") - F.lit(EMPTY_DENSITY)) * F.pow(
        F.lit(2.0), -F.col("age") / F.lit(HALFLIFE)
    )
    return ahead.groupBy(
        "conflict", (F.col("month") + F.col("age")).alias("month"), "cell"
    ).agg(F.sum(added).alias("extra"))


def numbered_cells(area_cells: DataFrame) -> DataFrame:
    """Cells of an area numbered from 0, with their number. This is a table of
    the grid, which is fixed and does not grow with the events."""
    place = Window.partitionBy("area").orderBy("cell")
    return area_cells.select(
        "area",
        "cell",
        (F.row_number().over(place) - 1).cast("long").alias("at"),
        F.count(F.lit(1)).over(Window.partitionBy("area")).alias("cells"),
    )


def _each_draw(draws: int | Sequence[int]) -> Column:
    """A row per draw: 1 to a number, or the given ones."""
    numbers = F.sequence(F.lit(1), F.lit(draws)) if isinstance(draws, int) else F.array(*map(F.lit, draws))
    return F.explode(numbers).alias("draw")


def _dealt_out(events: DataFrame) -> DataFrame:
    """Rows of few bytes that unfold later: as many tasks as there are partitions,
    where their bytes alone would gather them into one."""
    return events.repartition(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def draw_cells(
    vague: DataFrame,
    exact: DataFrame,
    area_cells: DataFrame,
    draws: int | Sequence[int] = DRAWS,
    seed: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Draw `draws` cells, with replacement, for each event of known area only;
    or the draws of the given numbers.

    `vague` has id, area, conflict, month and the columns to `keep`. A cell's weight is the sum over
    the month and the twelve before of its density (100 per event of the same
    conflict, 1 if none), halved every twelve months.

    Every cell has the same base weight and only few have more, so a draw
    first falls into the base part, where the cell follows from arithmetic, or
    into the extra part. There it is looked up in a guide table: the extra
    weights laid end to end are cut into as many slots as there are cells with
    extra weight, and each slot lists the cells it overlaps, less than two on
    average. No draw is ever paired with all cells of its area. The weights, the
    events and what is known of them are written once, as both parts read them.
    Result: id, draw, cell and what is kept.
    """
    cells = numbered_cells(area_cells)
    sizes = area_cells.groupBy("area").agg(F.count(F.lit(1)).alias("cells"))

    keys = ["conflict", "month", "area"]
    vague = stored(vague.select("id", *keys, *keep), "vague")
    wanted = vague.select(*keys).distinct()
    extras = (
        extra_weights(exact)
        .join(cells.select("area", "cell"), "cell")
        .join(wanted, keys, "left_semi")
    )
    in_order = Window.partitionBy(*keys).orderBy("cell")
    whole = Window.partitionBy(*keys)
    running = extras.withColumn(
        "stop", F.sum("extra").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    laid = running.select(
        *keys,
        "cell",
        F.lag("stop", 1, 0.0).over(in_order).alias("start"),
        "stop",
        F.max("stop").over(whole).alias("extra_total"),
        F.count(F.lit(1)).over(whole).alias("slots"),
    )
    laid = stored(laid, "weights")
    totals = laid.groupBy(*keys).agg(
        F.max("extra_total").alias("extra_total"), F.max("slots").alias("slots")
    )
    width = F.col("extra_total") / F.col("slots")
    slot_of = lambda v: F.least(F.floor(v / width), F.col("slots") - 1)
    guide = laid.select(
        *keys,
        "cell",
        "start",
        "stop",
        F.explode(F.sequence(slot_of(F.col("start")), slot_of(F.col("stop")))).alias("slot"),
    )

    events = salted_join(salted_join(vague, sizes, ["area"]), totals, keys, "left")
    events = stored(_dealt_out(events), "events")
    base_total = F.col("cells") * F.lit(BASE_WEIGHT)
    whole_weight = base_total + F.coalesce("extra_total", F.lit(0.0))
    # Unfolded as an array of one, the digest is taken once and not anew for
    # every filter and column that needs it.
    drawn = (
        events.select("*", _each_draw(draws))
        .select("*", F.explode(F.array(uniform("id", "draw", seed) * whole_weight)).alias("u"))
        .withColumn("over", F.col("u") - base_total)
    )
    in_base = drawn.filter(F.col("over") < 0).select(
        "id",
        "draw",
        "area",
        F.least(F.floor(F.col("u") / BASE_WEIGHT), F.col("cells") - 1).alias("at"),
        *keep,
    )
    from_base = in_base.join(cells.select("area", "at", "cell"), ["area", "at"]).select(
        "id", "draw", "cell", *keep
    )
    # The last interval is closed above, so rounding at the very end is caught.
    in_extra = drawn.filter(F.col("over") >= 0).withColumn(
        "over", F.least(F.col("over"), F.col("extra_total") * (1 - 1e-15))
    )
    in_extra = in_extra.select("id", "draw", *keys, "over", slot_of(F.col("over")).alias("slot"), *keep)
    from_extra = (
        in_extra.join(guide, [*keys, "slot"])
        .filter((F.col("over") >= F.col("start")) & (F.col("over") < F.col("stop")))
        .select("id", "draw", "cell", *keep)
    )
    return from_base.unionByName(from_extra)


def assemble_draws(drawn: DataFrame, exact: DataFrame, draws: int = DRAWS) -> DataFrame:
    """Drawn events together with the exactly located ones, which keep their
    cell in every draw; equal rows once."""
    same = exact.select("id", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"), "cell")
    return drawn.unionByName(same).distinct()


ATTRIBUTES = ("kind", "month_start", "month_end")


def imputed_dummies(
    placed: DataFrame,
    events: DataFrame,
    kinds: Mapping[str, int],
    seed: int = 1,
) -> DataFrame:
    """0/1 flags per draw, cell and month.

    `placed` has id, draw, cell; `events` has id, kind, month_start, month_end.
    Each event is put into a month between its start and end, anew per draw and
    event kind. Result: draw, cell, month and one flag per kind, for the
    cell-months that have any event.
    """
    joined = placed.join(events.select("id", *ATTRIBUTES), "id")
    return _flags(joined, kinds, seed)


def dummies_of_events(
    vague: DataFrame,
    exact: DataFrame,
    area_cells: DataFrame,
    events: DataFrame,
    kinds: Mapping[str, int],
    draws: int | Sequence[int] = DRAWS,
    seed: int = 1,
) -> DataFrame:
    """`imputed_dummies` of the vague events' draws and the exact events.

    What `events` tells is joined before the draws unfold, so that only flags are
    shuffled by draw; equal rows need not be taken out, as they set the same flags.
    """
    dated = events.select("id", *ATTRIBUTES)
    drawn = draw_cells(vague.join(dated, "id"), exact, area_cells, draws, seed, ATTRIBUTES)
    same = _dealt_out(exact.select("id", "cell")).join(dated, "id")
    same = same.select("id", _each_draw(draws), "cell", *ATTRIBUTES)
    return _flags(drawn.unionByName(same), kinds, seed)


def _flags(placed: DataFrame, kinds: Mapping[str, int], seed: int) -> DataFrame:
    """Flags of placed events that have their kind and span.

    The draws of a cell-month are bits of one number, so that they are combined
    before the shuffle and unfold after it. Events of an unknown kind make a row
    but no flag, missing if there are no others.
    """
    span = F.col("month_end") - F.col("month_start") + 1
    month = F.col("month_start") + F.least(
        F.floor(uniform("id", "draw", "kind", seed) * span), span - 1
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("draw", F.lit(WORD)).cast("int"))
    masks = {"_any": F.lit(True), "_known": F.col("kind").isNotNull()}
    masks |= {f"_{name}": F.col("kind") == code for name, code in kinds.items()}
    words = (
        placed.select("cell", "kind", month.cast("long").alias("month"), F.floor(F.col("draw") / WORD).alias("_word"), bit.alias("_bit"))
        .groupBy("cell", "month", "_word")
        .agg(*[F.bit_or(F.when(on, F.col("_bit")).otherwise(F.lit(0))).alias(m) for m, on in masks.items()])
    )
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit("_any", b) == 1)
    return words.withColumn("_place", F.explode(places)).select(
        (F.col("_word") * WORD + F.col("_place")).alias("draw"),
        "cell",
        "month",
        *[
            F.when(F.getbit("_known", "_place") == 1, F.getbit(f"_{name}", "_place").cast("int")).alias(f"dummy_{name}")
            for name in kinds
        ],
    )


def dummies_on_skeleton(
    skeleton: DataFrame, dummies: DataFrame, draw: int, cell: str, month: str
) -> DataFrame:
    """The flags of one draw on all cell-months, 0 where there is none."""
    one = dummies.filter(F.col("draw") == draw).drop("draw")
    one = one.withColumnsRenamed({"cell": cell, "month": month})
    flags = [c for c in one.columns if c.startswith("dummy_")]
    joined = skeleton.join(one, [cell, month], "left")
    return joined.select(
        *skeleton.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in flags]
    )
