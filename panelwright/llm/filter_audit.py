"""What each filter removes under every order of the filters.

A document is the set of filters that it fails (a mask). In lexicographic order
of the permutations, all orders that begin with the same letters are one interval
of ranks. So the orders in which a mask is removed at a step are intervals: a
beginning of filters that it passes, then one that it fails. Counts of masks are
added at the first rank of an interval and taken off behind its last one; a
prefix sum over the ranks gives the totals of all orders.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.lineage import cut, stored
from panelwright.llm.base import corpus_query, table

# White space of words, and the signs that filter D looks for.
BLANKS, SIGNS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5
FILTERS = "ABCDE"


def lehmer_rank(order: str, letters: str) -> int:
    """Place of a permutation of `letters` among all in lexicographic order; of
    a beginning, the place of the first permutation that begins so."""
    rank, left = 0, sorted(letters)
    for letter in order:
        at = left.index(letter)
        rank += at * factorial(len(left) - 1)
        left.pop(at)
    return rank


def removal_intervals(mask: int, letters: str) -> list[tuple[int, int, int]]:
    """(step, first rank, rank behind the last) of all intervals of orders in
    which a document that fails the filters of `mask` is removed at the step."""
    fails = [f for i, f in enumerate(letters) if mask >> i & 1]
    passes = [f for f in letters if f not in fails]
    out = []
    for before in range(len(passes) + 1 if fails else 0):
        size = factorial(len(letters) - before - 1)
        for beginning in permutations(passes, before):
            for last in fails:
                first = lehmer_rank("".join((*beginning, last)), letters)
                out.append((before + 1, first, first + size))
    return out


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails the filters A to D; a null text is an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        100 * capitals > MAX_CAPITALS * F.length(text),
        text.rlike(SIGNS),
    ]


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): bit i is set if the row fails filter i of FILTERS.

    E: a row with a smaller doc_id has the same text. Rows that repeat text and
    doc_id do not fail it for one another; a null doc_id is neither smaller nor
    larger."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text")))]
    rows = cut(
        docs.select(
            "doc_id",
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            sum(bits[1:], bits[0]).alias("failed"),
            F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
        )
    )
    # Written, so that the join shuffles two plain tables and adaptive skew join
    # can deal a hot text out; only texts that several rows have are in it.
    first = stored(
        rows.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select("digest", "first"),
        "first-of-text",
    )
    last = 1 << (len(FILTERS) - 1)
    again = F.when(F.col("doc_id") > F.col("first"), last).otherwise(0)
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("failed") + again).alias("mask"))


def audit(masked: DataFrame, marks: dict[str, str], letters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, zeros included: kept,
    removed, redundant, unique_fails, a count of removed rows for each of `marks`
    (name of the count: boolean column of `masked`, null is false), and shapley.

    `masked` has (part, mask). The work after the first aggregate depends on the
    number of parts only, never on the rows. An empty table gives no rows."""
    n = factorial(len(letters))
    counts = cut(
        masked.groupBy("part", "mask").agg(
            F.count("*").alias("removed"),
            *[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(name) for name, c in marks.items()],
        )
    )
    names = ["removed", *marks]
    whole = (1 << len(letters)) - 1
    ends = F.create_map(
        *[
            x
            for mask in range(1, whole + 1)
            for x in (
                F.lit(mask),
                F.array(
                    *[
                        F.struct(F.lit(step).alias("step"), F.lit(rank).alias("rank"), F.lit(sign).alias("sign"))
                        for step, first, behind in removal_intervals(mask, letters)
                        for rank, sign in ((first, 1), (behind, -1))
                    ]
                ),
            )
        ]
    )
    # Difference arrays: the counts at the ends of intervals.
    changes = (
        counts.where("mask > 0")
        .select("part", *names, F.explode(ends[F.col("mask")]).alias("e"))
        .groupBy("part", "e.step", "e.rank")
        .agg(*[F.sum(F.col("e.sign") * F.col(c)).alias(c) for c in names])
    )
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("removed")).otherwise(0)) for i in range(len(letters))]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("removed")).otherwise(0)) for i in range(len(letters))]
    parts = cut(
        counts.groupBy("part").agg(
            F.sum("removed").alias("rows"), F.array(*failing).alias("failing"), F.array(*alone).alias("alone")
        )
    )
    orders = F.array(*[F.lit("".join(o)) for o in permutations(letters)])
    grid = (
        parts.select("*", F.posexplode(orders).alias("rank", "filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
        .withColumn("at", F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1)
    )
    by_rank = Window.partitionBy("part", "step").orderBy("rank")
    totals = grid.join(changes, ["part", "step", "rank"], "left").select(
        *grid.columns, *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(by_rank).alias(c) for c in names]
    )
    by_step = Window.partitionBy("part", "filter_order").orderBy("step")
    by_filter = Window.partitionBy("part", "at")
    return totals.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        (F.col("rows") - F.sum("removed").over(by_step)).alias("kept"),
        "removed",
        (F.col("failing")[F.col("at")] - F.col("removed")).alias("redundant"),
        F.col("alone")[F.col("at")].alias("unique_fails"),
        *marks,
        F.sum("removed").over(by_filter).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters over documents, by source.

    Null texts are empty, null sources the part "". A document is good or toxic
    if any row of `labels` (doc_id, quality, toxic) with its id says 1. Repeated
    rows count each; an empty table gives no rows; other columns are not read. A
    text is one row: its words are held once, some fifty bytes a word.
    """
    marked = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    rows = masks(docs).join(marked, F.col("doc_id") == F.col("_id"), "left")
    return audit(rows, {"good_lost": "good", "toxic_lost": "toxic"})


@corpus_query(
    "op13_filter_audit",
    r"""
    WITH t AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    d AS (
      SELECT doc_id, part,
             len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
      FROM t),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    m AS (
      SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
                          CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END,
                          CASE WHEN e THEN 'E' ELSE '' END) AS fails,
             count(*) AS n, count_if(coalesce(good, false)) AS good, count_if(coalesce(toxic, false)) AS toxic
      FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    o AS (
      SELECT concat(p.f, q.f, r.f, s.f, t.f) AS filter_order
      FROM f p, f q, f r, f s, f t
      WHERE p.f NOT IN (q.f, r.f, s.f, t.f) AND q.f NOT IN (r.f, s.f, t.f)
        AND r.f NOT IN (s.f, t.f) AND s.f <> t.f),
    g AS (
      SELECT part, filter_order, step, substr(filter_order, CAST(step AS INT), 1) AS letter,
             substr(filter_order, 1, CAST(step AS INT) - 1) AS earlier
      FROM (SELECT DISTINCT part FROM m), o, (SELECT unnest(range(1, 6)) AS step)),
    r AS (
      SELECT g.part, filter_order, step, letter,
             sum(n) FILTER (translate(fails, earlier || letter, '') = fails) AS kept,
             sum(n) FILTER (contains(fails, letter) AND translate(fails, earlier, '') = fails) AS removed,
             sum(n) FILTER (contains(fails, letter) AND translate(fails, earlier, '') <> fails) AS redundant,
             sum(n) FILTER (fails = letter) AS unique_fails,
             sum(good) FILTER (contains(fails, letter) AND translate(fails, earlier, '') = fails) AS good_lost,
             sum(toxic) FILTER (contains(fails, letter) AND translate(fails, earlier, '') = fails) AS toxic_lost
      FROM g JOIN m ON g.part = m.part GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INT) AS step,
           CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
           CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
           CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
           CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
           CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
    FROM r
    """,
)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
