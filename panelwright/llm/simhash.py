"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within three bits have a common word within half that radius
of each. Emitting every word within two bits would be 2 081 words a
fingerprint, so the 64 bits are first cut into three blocks and one block is
masked: over the masks, some mask leaves a difference of at most two bits and
hides at most one (or hides all three, see `_links`). Half of two is one: each
fingerprint emits 44 words a mask, 132 in all. Words that meet are grouped by
the masked block in the same way, where the parity of the block tells which of
two sides flips, and linked as stars, never as all pairs. Words whose members
are already in one class are left out of that, so dense groups flip no blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.lineage import cut, stored
from panelwright.llm.base import corpus_query, table
from panelwright.llm.components import connected_components

SHINGLE, SEED, RADIUS = 3, 42, 3
BLOCKS = ((0, 21), (21, 42), (42, 64))


def text_fingerprint(text: str) -> int:
    """SimHash of the text's word shingles, as an unsigned number."""
    # bytes.lower() and bytes.split() know A-Z and [\x20\x09-\x0D] only.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        joined = [b" ".join(words)]
    else:
        whole = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: 1 - SHINGLE - 1])).tolist()
        joined = [whole[a:b] for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in joined), np.uint64, len(joined))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column) -> Column:
    """The fingerprint as a signed long; a null text is an empty one."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            prints = np.fromiter(
                (text_fingerprint(t) if t else 0 for t in batch), np.uint64, len(batch)
            )
            yield pd.Series(prints.view(np.int64))

    return of(text)


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _flips(bits: Iterable[int], sizes: tuple[int, ...]) -> Column:
    """Literal array of all patterns of as many of the bits as `sizes` says."""
    patterns = [sum(1 << i for i in some) for n in sizes for some in combinations(bits, n)]
    return F.array(*[F.lit(_signed(p)).cast("long") for p in patterns])


def _links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) over distinct fingerprints (fp) that join all pairs within
    three bits, directly or over other fingerprints within three bits.

    Per mask, fingerprints meet on (word, block): `word` is the open part with
    at most one bit flipped, `block` the masked part. At most two differing bits
    leave some mask that hides none of them, so their own blocks meet. Of three,
    some mask hides one: the two blocks differ in parity, so it is enough that
    the even one is flipped, a bit at a time. Or a mask hides all three: then
    the open parts are equal, the even block flips two bits and the odd one one.

    In a group the members that flip fewer bits (centres) are within two bits
    of each other and within three of the rest, so all link to the smallest.

    Blocks are flipped only where that can join something: members of a word are
    first linked to its smallest fingerprint if that is within three bits, and
    words whose members are one class by then go. Members of a word that link
    have blocks that differ in one bit at most (a centre flips none), so they
    agree in two of three parts of the block; who agrees with nobody goes too.
    """
    words, same = (stored(_met(_words(prints, sizes)), "words") for sizes in ((0, 1), (0,)))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= RADIUS
    first = words.unionByName(same).where((F.col("fp") != F.col("least")) & near)
    first = cut(first.select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct())
    roots = stored(connected_components(first), "word-classes")
    words, same = _apart(words, roots), _apart(same, roots)
    links = first
    for mask, (low, high) in enumerate(BLOCKS):
        hidden, bits = F.lit(_signed(_block(low, high))), range(low, high)
        of_words, of_same = (met.where(F.col("mask") == mask).select("word", "fp") for met in (words, same))
        links = links.unionByName(_star(_close(of_words, low, high), hidden, bits, even=(0, 1), odd=(0,)))
        links = links.unionByName(_star(of_same, hidden, bits, even=(2,), odd=(1,)))
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).distinct()


def _block(low: int, high: int) -> int:
    return sum(1 << i for i in range(low, high))


def _words(prints: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """(mask, word, fp): per mask the open part with as many bits flipped."""
    out = None
    for mask, (low, high) in enumerate(BLOCKS):
        shown = F.col("fp").bitwiseAND(F.lit(_signed(~_block(low, high) & (1 << 64) - 1)))
        flips = _flips([i for i in range(64) if not low <= i < high], sizes)
        rows = prints.select("fp", F.explode(flips).alias("flip"))
        rows = rows.select(F.lit(mask).alias("mask"), shown.bitwiseXOR(F.col("flip")).alias("word"), "fp")
        out = rows if out is None else out.unionByName(rows)
    return out


def _met(rows: DataFrame) -> DataFrame:
    """The rows whose word has at least two fingerprints, with the smallest."""
    group = Window.partitionBy("mask", "word")
    return (
        rows.withColumn("least", F.min("fp").over(group))
        .withColumn("most", F.max("fp").over(group))
        .where("least < most")
        .drop("most")
    )


def _apart(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(mask, word, fp) of the words whose members are in two or more classes."""
    group = Window.partitionBy("mask", "word")
    classed = met.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    several = classed.withColumn("low", F.min("root").over(group)).withColumn("high", F.max("root").over(group))
    return stored(several.where("low < high").select("mask", "word", "fp"), "words-apart")


def _close(met: DataFrame, low: int, high: int) -> DataFrame:
    """The rows (word, fp) that agree with another one of their word in all but
    one of three parts of the block."""
    edges = [low + (high - low) * k // 3 for k in range(4)]
    keys = []
    for part, (start, end) in enumerate(zip(edges, edges[1:])):
        rest = F.lit(_signed(_block(low, high) & ~_block(start, end)))
        keys.append(F.struct(F.lit(part).alias("part"), F.col("fp").bitwiseAND(rest).alias("rest")))
    group = Window.partitionBy("word", "part", "rest")
    return (
        met.select("word", "fp", F.explode(F.array(*keys)).alias("key"))
        .select("word", "fp", "key.*")
        .withColumn("least", F.min("fp").over(group))
        .withColumn("most", F.max("fp").over(group))
        .where("least < most")
        .select("word", "fp")
        .distinct()
    )


def _star(met: DataFrame, hidden: Column, bits: range, even: tuple[int, ...], odd: tuple[int, ...]) -> DataFrame:
    """Link members that share (word, block) to the smallest centre. A member
    emits its own block with as many bits flipped as the block's parity allows;
    centres are those that flip no more than an odd block does."""
    own = F.col("fp").bitwiseAND(hidden)
    flips = F.when(F.bit_count(own) % 2 == 0, _flips(bits, even)).otherwise(_flips(bits, odd))
    near = F.bit_count("flip") <= max(odd)
    rows = met.select("word", "fp", F.explode(flips).alias("flip")).select(
        "word", "fp", own.bitwiseXOR(F.col("flip")).alias("block"), near.alias("near")
    )
    hub = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("word", "block"))
    return (
        rows.withColumn("hub", hub)
        .where("hub is not null and hub <> fp")
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id.

    component_id is the smallest doc_id reachable over links of at most three
    differing bits, itself included. A null text counts as empty; texts without
    words have fingerprint zero and link like any other; a null doc_id is kept
    and never is the smallest. Repeated rows each give a row. An empty table
    gives an empty result; other columns are not read.
    """
    prints = cut(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(_links(cut(nodes.select("fp"))))
    reached = roots.join(nodes, roots.node == nodes.fp).select("node", "root", "least")
    joint = reached.groupBy("root").agg(F.min("least").alias("joint"))
    of_node = reached.join(joint, "root").select(F.col("node").alias("fp"), "joint")
    classes = cut(
        nodes.join(of_node, "fp", "left").select("fp", F.coalesce("joint", "least").alias("component_id"))
    )
    # A fingerprint that very many documents share is one row of `classes`,
    # which is written, so that two plain tables are shuffled and adaptive skew
    # join can deal its documents out.
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of their component; a
    null doc_id stays only where no other document is in its component."""
    stays = (
        near_duplicates(docs)
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_stays"))
        .distinct()
    )
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["_stays"]), "left_semi")


@corpus_query("op8_simhash")
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
