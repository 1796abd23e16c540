"""Entries of HTML pages, taken out with patterns by a Spark job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import recode, split_names
from panelwright.operators.reshape import first_per_key


@dataclass(frozen=True)
class EntryPatterns:
    """Where an entry is in a page and its parts in the entry.

    The first group of each pattern is the value. `flags` maps a column to
    text that marks it.
    """

    entry: str
    name: str
    date: str
    text: str
    flags: Mapping[str, str] = field(default_factory=dict)


# The markers and tags of the monthly watch-list pages.
WATCH_LIST = EntryPatterns(
    entry=r'(?s)(<div class="c-crisiswatch-entry[^"]*".*?)(?=<div class="c-crisiswatch-entry|\z)',
    name=r"(?s)<h3[^>]*>(.*?)</h3>",
    date=r"(?s)<time[^>]*>(.*?)</time>",
    text=r'(?s)<div class="o-crisis-states__detail[^"]*"[^>]*>(.*?)</div>',
    flags={
        "alerts": "#risk-alert",
        "opportunities": "#resolution",
        "deteriorated": "#deteriorated",
        "improved": "#improved",
    },
)


def plain_text(html: Column) -> Column:
    """Text without tags, trimmed."""
    return F.trim(F.regexp_replace(html, r"(?s)<[^>]*>", ""))


def page_entries(
    pages: DataFrame, html: str, patterns: EntryPatterns, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per entry: name, date, 0/1 flags, `unobserved` = 0 and text.

    Whole pages are searched; a page without entries gives no row, an entry
    without text an empty one.
    """
    found = F.explode(F.regexp_extract_all(F.col(html), F.lit(patterns.entry), F.lit(1)))
    rows = pages.select(*keep, found.alias("_entry"))
    part = lambda pattern: plain_text(F.regexp_extract("_entry", pattern, 1))
    return rows.select(
        *keep,
        part(patterns.name).alias("name"),
        part(patterns.date).alias("date"),
        *[
            F.col("_entry").contains(marker).cast("int").alias(flag)
            for flag, marker in patterns.flags.items()
        ],
        F.lit(0).alias("unobserved"),
        part(patterns.text).alias("text"),
    )


def drop_unnamed(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("name") != "")


def split_entries(entries: DataFrame) -> DataFrame:
    """One entry per name of a name that joins several with a slash."""
    others = [c for c in entries.columns if c != "name"]
    return entries.select(*others, F.explode(split_names("name")).alias("name")).select(
        *entries.columns
    )


def clean_entries(
    entries: DataFrame,
    renames: Sequence[tuple[str, str]] = (),
    drops: Sequence[str] = (),
) -> DataFrame:
    """Split, rename, split again (a new name may join two), drop some names."""
    out = split_entries(drop_unnamed(entries))
    out = out.withColumn("name", recode("name", list(renames)))
    return split_entries(out).filter(~F.col("name").isin(*drops)) if drops else split_entries(out)


def entries_per_month(
    entries: DataFrame, date: Column, order: Sequence[str | Column]
) -> DataFrame:
    """The first entry of each year, month and name."""
    dated = entries.withColumns({"year": F.year(date), "month": F.month(date)})
    return first_per_key(dated, ["year", "month", "name"], order)
