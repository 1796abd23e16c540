"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

The first pass hashes every normalised text to a cell of a bit table and sets
the bits that more than one row hit. The second pass tests each row against the
table: a row whose bit is unset has no equal, so it passes straight through;
only the others are shuffled and compared by their full SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import cut
from panelwright.llm.base import corpus_query, table

# The characters that do not count, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

# The bit table: at least this many cells a row, in powers of two, and at most
# 2 ** MOST_BITS cells, so that the broadcast table is 64 MB at most. Beyond
# that more rows than need be are taken for repeated, and are shuffled.
CELLS_PER_ROW = 16
LEAST_BITS, MOST_BITS = 20, 29
CHUNK = 4096 * 8  # bits of one bitmap of Spark's bitmap functions


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _bits(rows: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (rows * CELLS_PER_ROW - 1).bit_length()))


def _cell(digest: Column, bits: int) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").bitwiseAND((1 << bits) - 1)


def repeated_cells(digests: DataFrame, bits: int) -> DataFrame:
    """First pass: the chunks (chunk, bitmap) of the table of cells that two or
    more rows of `digests` (digest) hit; at most 2 ** bits / CHUNK rows."""
    cells = digests.groupBy(_cell(F.col("digest"), bits).alias("cell")).count()
    hit = cells.where("count > 1")
    return hit.groupBy(F.expr(f"cell div {CHUNK}").alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("cell") % CHUNK).alias("bitmap")
    )


def flag_repeated(rows: DataFrame, bits: int) -> DataFrame:
    """Second pass: add `possible`, true where the row's bit is set."""
    bitmaps = F.broadcast(repeated_cells(rows.select("digest"), bits))
    place = _cell(F.col("digest"), bits) % CHUNK
    octet = F.conv(
        F.hex(F.substring("bitmap", (place / 8).cast("int") + 1, F.lit(1))), 16, 10
    ).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))
    return (
        rows.withColumn("chunk", F.floor(_cell(F.col("digest"), bits) / CHUNK))
        .join(bitmaps, "chunk", "left")
        .withColumn("possible", F.coalesce(octet.bitwiseAND(mask) != 0, F.lit(False)))
        .drop("chunk", "bitmap")
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without blanks; a null text is an
    empty one. Of equal texts the row with the most code points, then the
    smallest doc_id stays (a null doc_id comes last). Rows that repeat both
    text and doc_id cannot be told apart: each counts in group_size and all
    carry the same `kept`. An empty table gives an empty result; other columns
    are not read.
    """
    # Written once: the passes read some eighty bytes a row and no text again.
    rows = cut(
        docs.select(
            "doc_id",
            F.sha2(normalised(F.col("text")), 256).alias("digest"),
            F.coalesce(F.length("text"), F.lit(0)).alias("size"),
        )
    )
    flagged = flag_repeated(rows, _bits(rows.count()))
    alone = flagged.where(~F.col("possible")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    possible = flagged.where("possible")
    # Partial aggregates make a hot group one row per task before the shuffle.
    # The result is written, so that the join below shuffles two plain tables
    # and can deal a hot group out over tasks (adaptive skew join).
    best = cut(
        possible.groupBy("digest").agg(
            F.min(
                F.struct((-F.col("size")).alias("rank"), F.col("doc_id").isNull().alias("none"), "doc_id")
            ).alias("best"),
            F.count("*").alias("group_size"),
        )
    )
    grouped = possible.join(best, "digest").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (
            F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
            & (F.col("size") == -F.col("best.rank"))
        ).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with all their columns, one for each text without
    blanks: the longest, then smallest doc_id, and one of rows that are alike.
    Rows whose bit is unset pass with their text unshuffled."""
    own = docs.columns
    digest = F.sha2(normalised(F.col("text")), 256).alias("digest")
    rows = docs.select(digest, F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    flagged = flag_repeated(rows, _bits(docs.count()))
    order = F.struct(
        -F.coalesce(F.length("row.text"), F.lit(0)), F.col("row.doc_id").isNull(), F.col("row.doc_id")
    )
    kept = flagged.where("possible").groupBy("digest").agg(F.min_by("row", order).alias("row"))
    alone = flagged.where(~F.col("possible")).select("row")
    return alone.unionByName(kept.select("row")).select("row.*")


@corpus_query(
    "op7_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, length(coalesce(text, '')) AS size,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
      FROM documents),
    r AS (
      SELECT doc_id, h, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS n
      FROM t WINDOW w AS (PARTITION BY h ORDER BY size DESC, doc_id))
    SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, doc_id = keep_id AS kept,
           h AS text_sha256
    FROM r
    """,
)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))
