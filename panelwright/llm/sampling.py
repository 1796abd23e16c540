"""The labelled rows that classifiers are fitted on, all of them or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row's labels must not be learnt: crc32 of its id as text. A
    null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


# Labelled ids that are broadcast at most (some 30 bytes each).
BROADCAST_ROWS = 1 << 20


def known_labels(labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, label), one row per id with a label outside the held-out fold."""
    known = labels.where(f"{label} in (0, 1) and doc_id is not null").where(
        ~held_out(F.col("doc_id"), folds, fold)
    )
    return known.groupBy("doc_id").agg(F.max(label).alias("label"))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, text, lang, label) of all labelled rows outside the held-out
    fold. Texts are shuffled only where there are very many labels."""
    known = known_labels(labels, label, folds, fold)
    known = F.broadcast(known) if labels.count() <= BROADCAST_ROWS else known
    texts = docs.select("doc_id", "text", _language(docs))
    return texts.where(~held_out(F.col("doc_id"), folds, fold)).join(known, "doc_id")


def _language(docs: DataFrame) -> Column:
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return language.alias("lang")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int, longest: int
) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, lang, label) of at most `per_class` rows of each class, by
    a hash of the id and outside the held-out fold, whose text has at most
    `longest` characters; and the number of labelled rows of each class. The
    choice is small and is broadcast, so no text is shuffled."""
    known = known_labels(labels, label, folds, fold)
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id", F.lit(label))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select("doc_id", "text", _language(docs))
    texts = texts.where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    return texts.join(F.broadcast(chosen), "doc_id"), sizes
