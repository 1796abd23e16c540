"""Event records to panel rows: typing, tagging, dating and counting.

Where the counting functions themselves are only known by name and use, the
meaning chosen here is in the docstring.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import last_match, month_id, tag_letters
from panelwright.functions.windows import onset, onset_possible
from panelwright.operators.spatial import spatial_sum
from panelwright.panel import Panel

# The actor and interaction codes behind the type and tag rules.
STATE_BASED, NON_STATE, ONE_SIDED, PROTEST = 1, 2, 3, 4
PROTESTER_CODE, RIOTER_CODE = 6, 5
REPRESSION_CODES = (15, 16, 25, 26, 35, 36, 45, 46)
STATE_REPRESSION_CODES = (15, 16)
IMPRECISE_LOCATION_CODES = (4, 6, 7)
PRECISE_BELOW = 3


def violence_type(
    event_type: Column, actor1: Column, actor2: Column, words: Mapping[str, str] | None = None
) -> Column:
    """Type 1 to 4 of an event; the last rule that holds decides.

    The two actors are read as one text, so an event that lacks either actor
    matches no rule about actors. `words` replaces the search words.
    """
    # The words looked for, in any case.
    look = {
        "battle": "battle",
        "remote": "remote",
        "civilian_event": "civi",
        "protest": "protest",
        "military": "military forces",
        "civilians": "civilians",
    } | dict(words or {})

    def says(text: Column, word: str) -> Column:
        return text.ilike(f"%{look[word]}%")

    actors = F.concat(actor1, actor2)
    fighting = says(event_type, "battle") | says(event_type, "remote")
    military, civilians = says(actors, "military"), says(actors, "civilians")
    return last_match(
        [
            (fighting & military & ~civilians, STATE_BASED),
            (fighting & ~military & ~civilians, NON_STATE),
            ((fighting | says(event_type, "civilian_event")) & civilians, ONE_SIDED),
            (says(event_type, "protest"), PROTEST),
        ]
    )


def protest_tag(
    kind: Column,
    inter1: Column,
    inter2: Column,
    event_type: Column,
    interaction: Column,
    violence_word: str = "violence against civi",
) -> Column:
    """Letters p, r, x, y for protesters, rioters and two kinds of repression."""
    protest = kind == PROTEST
    against = event_type.ilike(f"%{violence_word}%")
    return tag_letters(
        {
            "p": protest & ((inter1 == PROTESTER_CODE) | (inter2 == PROTESTER_CODE)),
            "r": protest & ((inter1 == RIOTER_CODE) | (inter2 == RIOTER_CODE)),
            "x": against & interaction.isin(*REPRESSION_CODES),
            "y": against & interaction.isin(*STATE_REPRESSION_CODES),
        }
    )


def drop_imprecise(df: DataFrame, col: str, codes: Sequence[int] = IMPRECISE_LOCATION_CODES) -> DataFrame:
    """Leave out events whose location code is in the list.

    A missing code is kept: deleting by a condition leaves unknown rows alone.
    """
    return df.filter(F.coalesce(~F.col(col).isin(*codes), F.lit(True)))


def only_precise(df: DataFrame, col: str, below: int = PRECISE_BELOW) -> DataFrame:
    return df.filter(F.col(col) < below)


def attach_months(
    df: DataFrame, year: str, start: str, end: str
) -> DataFrame:
    """Month ids of the start and end date, both with the event's own year."""
    return df.withColumns(
        {
            "month_start": month_id(F.col(year), F.month(start)),
            "month_end": month_id(F.col(year), F.month(end)),
        }
    )


def on_earth(lat: Column, lon: Column) -> Column:
    """Whether a coordinate is possible."""
    return lat.between(-90, 90) & lon.between(-180, 180)


def count_events(
    events: DataFrame,
    by: Sequence[str],
    kind: str,
    kinds: Mapping[str, object],
    value: str | None = None,
) -> DataFrame:
    """Counts and sums per cell and time, one column pair per event kind.

    One hash aggregate for all kinds, combined before the shuffle, so a cell
    or a month that holds a large share of the events is no problem. Gives
    `count_<name>` and, with a value column, `sum_<name>`.
    """
    aggs = []
    for name, code in kinds.items():
        hit = F.col(kind) == F.lit(code)
        aggs.append(F.count(F.when(hit, 1)).alias(f"count_{name}"))
        if value is not None:
            total = F.sum(F.when(hit, F.col(value)).otherwise(F.lit(0)))
            aggs.append(total.alias(f"sum_{name}"))
    return events.groupBy(*by).agg(*aggs)


def events_to_panel(
    skeleton: DataFrame,
    events: DataFrame,
    panel: Panel,
    kind: str,
    kinds: Mapping[str, object],
    value: str | None = None,
) -> DataFrame:
    """Counts per panel row; a row without events has 0."""
    counted = count_events(events, panel.keys, kind, kinds, value)
    cols = panel.values(counted)
    joined = skeleton.join(counted, panel.keys, "left")
    return joined.select(
        *skeleton.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in cols]
    )


def neighbour_counts(
    df: DataFrame,
    panel: Panel,
    adjacency: DataFrame,
    cols: Sequence[str],
    suffix: str = "_lag1",
) -> DataFrame:
    """Counts summed over the cell's neighbours, as further columns."""
    return spatial_sum(df, panel, adjacency, {c: f"{c}{suffix}" for c in cols})


def grouped_density(
    events: DataFrame, conflict: str, month: str, cell: str, factor: int = 100
) -> DataFrame:
    """Events per conflict, month and cell, times a factor."""
    return events.groupBy(conflict, month, cell).agg(
        (F.count(F.lit(1)) * factor).alias("density")
    )


def clipped_range(df: DataFrame, col: str, first: int, last: int) -> DataFrame:
    """A requested range cut to the one that the data covers."""
    return df.agg(
        F.greatest(F.lit(first), F.min(col)).alias("first"),
        F.least(F.lit(last), F.max(col)).alias("last"),
    )


def onset_in_quiet_neighbourhood(
    df: DataFrame,
    panel: Panel,
    adjacency: DataFrame,
    col: str,
    window: int,
    out: str = "onset_quiet",
) -> DataFrame:
    """1 for an onset in a cell none of whose neighbours had an event lately.

    A neighbour is quiet when it has no event in the rows of the window before
    this time. A cell without neighbours has a quiet neighbourhood.
    """
    marked = df.withColumns(
        {
            "_onset": onset(col, panel, window),
            "_busy": F.lit(1) - onset_possible(col, panel, window),
        }
    )
    summed = spatial_sum(marked, panel, adjacency, {"_busy": "_busy_near"})
    quiet = F.coalesce(F.col("_busy_near"), F.lit(0)) == 0
    return summed.select(
        *df.columns, (F.col("_onset") * quiet.cast("int")).cast("int").alias(out)
    )
