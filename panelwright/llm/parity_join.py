"""Jaccard similarity join of shingle sets by parity sketches.

A set is hashed into a sketch of bits, long and sparse: each member flips one
bit, so the Hamming distance of two sketches is at most the size of the symmetric
difference of their sets. A link of `percent` similarity between sets of n and m members
differs in at most (100 - percent) * (n + m) / (100 + percent) members, and
hence in no more bits, and in no more words of the sketch.

Sets are joined per band of sizes, first by coarse sketches of all texts and then
by fine sketches of the sets that have met another one:

1. In a band all coarse sketches have the same number of words, enough that a set
   has more non-empty words than a partner may differ in. By the pigeonhole
   principle partners then agree in at least `need` of their non-empty words.
   Words are keys. Keys that only one set has go, and so does a set that keeps
   fewer than `need`; of the others all but the `need` - 1 most frequent keys
   stay, and two partners still meet on one (prefix filter).
2. The words of fine sketches are single bits. There the overlap that partners
   must have bounds from each side how many of the rarest bits are needed, so
   that passages which very many sets share are not joined on.
3. Sets that meet are compared as stars, never as all pairs: of each key some
   sets are hubs, members of other classes are compared with them by their exact
   sets, the first links are contracted to classes, and the hubs leave the key;
   rounds take more hubs each and end when all keys hold one class each. Links left out lie within a class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.lineage import Rounds, cut, stored
from panelwright.llm.base import corpus_query, table
from panelwright.llm.components import connected_components
from panelwright.llm.shingles import batches, digest, mixed, shingler

SIZE, PERCENT = 4, 85
# Bands of set sizes grow by this factor; it must be above 100 / percent.
GROWTH = 1.6
# Words of a coarse sketch for each member of the smallest set of the band, and a
# few more, so that small sets have words to spare.
WORDS_PER_MEMBER, SPARE_WORDS = 0.4, 6
# Hubs of a key grow by this factor from round to round, up to the bound.
MORE_HUBS, MOST_HUBS = 16, 4096
# Rows that are broadcast at most (some 16 bytes each); characters of texts, and
# members of sets, whose keys are handed on at a time.
BROADCAST_ROWS, RUN_CHARS, RUN_MEMBERS = 1 << 20, 4 << 20, 1 << 20


def most_different(n: int, percent: int) -> int:
    """Members in which a set of n and any linked set can differ at most."""
    return (100 - percent) * (n + 100 * n // percent) // (100 + percent)


class Bands:
    """Bands of set sizes: band k begins at starts[k]. Sets that are too small
    to be linked to any other set (`least`) are in none."""

    def __init__(self, percent: int) -> None:
        if not 100 / GROWTH < percent < 100:
            raise ValueError("percent must lie between 100 / GROWTH and 100")
        self.percent = percent
        self.least = next(n for n in range(1, 10_000) if most_different(n, percent) > 0)
        self.starts = [self.least]

    def of(self, n: int) -> list[int]:
        """Bands in which a set of n members is joined: its own, and the one
        above where it can have a partner there."""
        if n < self.least:
            return []
        while self.starts[-1] <= 2 * n:
            self.starts.append(int(np.ceil(GROWTH * self.starts[-1])))
        own = int(np.searchsorted(self.starts, n, "right")) - 1
        above = 100 * n >= self.percent * self.starts[own + 1]
        return [own, own + 1] if above else [own]

    def words(self, hashes: np.ndarray, band: int) -> tuple[np.ndarray, int]:
        """(keys of a set in a band, how many of them a partner shares at least):
        the non-empty words of its sketch. A set with no words to spare (need
        below 1, by chance only) also has the band's own key, on which all such
        sets meet."""
        words = int(np.ceil(WORDS_PER_MEMBER * self.starts[band])) + SPARE_WORDS
        bits = mixed(hashes + np.uint64(band + 1))
        place = (bits >> np.uint64(6)) % np.uint64(words)
        order = np.argsort(place)
        place = place[order]
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        # A word is wide (2^58 bits) and sparse; it is held as the exclusive or
        # of the hashes of its set bits, so a bit that is flipped twice is gone.
        word = np.bitwise_xor.reduceat(mixed(bits[order]), starts)
        full = word != 0
        keys = mixed(mixed(word[full]) + place[starts][full] * np.uint64(1 << 20) + np.uint64(band))
        need = int(full.sum()) - most_different(len(hashes), self.percent)
        if need < 1:
            keys = np.append(keys, mixed(np.array([band], np.uint64)))
        return keys, need

    def bits(self, hashes: np.ndarray, band: int) -> np.ndarray:
        """Keys of the finest sketch, whose words are single bits."""
        return mixed(hashes + np.uint64(band + 1))


def _node(hashes: np.ndarray) -> int:
    """Name of a set as a signed long with the lowest bit free."""
    name = digest(hashes) & ~1
    return name - (1 << 64) if name >> 63 else name


def summaries(text: Column, size: int, percent: int) -> Column:
    """Struct: n, node (null for an empty set), and for the set's own band and
    the one above the words of its coarse sketch (keys_own, keys_above) and how
    many of them partners share at least (need_own, need_above); null where the
    set is not joined in that band."""

    @F.pandas_udf(
        "n long, node long, need_own long, need_above long, keys_own array<long>, keys_above array<long>"
    )
    def of(runs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingles, bands = shingler(size), Bands(percent)
        for texts in runs:
            rows = []
            for text in texts:
                found = shingles(text)
                words = [bands.words(found, b) for b in bands.of(len(found))]
                keys, needs = [k.view(np.int64) for k, _ in words], [need for _, need in words]
                node = _node(found) if len(found) else None
                rows.append((len(found), node, *(needs + [None, None])[:2], *(keys + [None, None])[:2]))
            # Column by column: nulls among plain numbers would make them floats.
            n, node, own, above, keys_own, keys_above = zip(*rows) if rows else [()] * 6
            numbers = zip(("n", "node", "need_own", "need_above"), (n, node, own, above))
            frame = {name: pd.array(values, "Int64") for name, values in numbers}
            for name, values in (("keys_own", keys_own), ("keys_above", keys_above)):
                frame[name] = pd.Series(list(values), dtype=object)
            yield pd.DataFrame(frame)

    return of(text)


def _units(keys: list, units: list, hashes: np.ndarray, node: int, bands: Bands, of: Callable) -> None:
    """Append the keys of a set. A unit is a set in a band: its node, plus 1 for
    the band above its own."""
    for above, band in enumerate(bands.of(len(hashes))):
        own = of(hashes, band)
        keys.append(own.view(np.int64))
        units.append(np.full(len(own), node + above, np.int64))


def _coarse_keys(rows: DataFrame) -> DataFrame:
    """(key, unit) of all sets, out of their summaries."""
    own = rows.select(F.explode("keys_own").alias("key"), F.col("node").alias("unit"))
    above = rows.select(F.explode("keys_above").alias("key"), (F.col("node") + 1).alias("unit"))
    return own.unionByName(above)


def _fine_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, unit) of sets (node, members)."""

    def of(runs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for frame in runs:
            for run in batches(frame["members"], RUN_MEMBERS):
                keys, units = [], []
                for node, members in zip(frame["node"].iloc[run], frame["members"].iloc[run]):
                    _units(keys, units, np.asarray(members, np.int64).view(np.uint64), node, bands, bands.bits)
                if keys:
                    yield pd.DataFrame({"key": np.concatenate(keys), "unit": np.concatenate(units)})

    return sets.mapInPandas(of, "key long, unit long")


def _sets(text: Column, size: int) -> Column:
    @F.pandas_udf("node long, members array<long>")
    def of(runs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingles = shingler(size)
        for texts in runs:
            rows = texts.tolist()
            for run in batches(rows, RUN_CHARS):
                found = [shingles(t) for t in rows[run]]
                nodes = [_node(h) if len(h) else 0 for h in found]
                yield pd.DataFrame({"node": nodes, "members": [h.view(np.int64) for h in found]})

    # Else a filter on the node is moved below the join that picks the texts, and
    # all texts are cut into shingles for it.
    return of.asNondeterministic()(text)


def _held(keys: DataFrame) -> DataFrame:
    """(key, unit, times): the keys that more than one set has, and how often."""
    # Counts are written first, so that the join shuffles two plain tables and
    # adaptive skew join can deal a hot key out.
    shared = stored(
        keys.groupBy("key")
        .agg(F.min("unit").alias("low"), F.max("unit").alias("high"), F.count("*").alias("times"))
        .where("low < high")
        .select("key", "times"),
        "shared-keys",
    )
    return stored(keys.join(shared, "key").groupBy("key", "unit").agg(F.max("times").alias("times")), "held-keys")


def _rarest(held: DataFrame, able: DataFrame) -> DataFrame:
    """Rows of `held` for the units in `able` (unit, first, ...), with the column
    `place` from rare to frequent, up to the place `first`."""
    order = Window.partitionBy("unit").orderBy("times", "key")
    return held.join(able, "unit").withColumn("place", F.row_number().over(order)).where("place <= first")


def _node_of(unit: str) -> Column:
    return F.col(unit).bitwiseAND(F.lit(-2).cast("long")).alias("node")


def _of_several(met: DataFrame) -> DataFrame:
    several = met.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return met.join(several.where("low < high").select("key"), "key")


def _by_words(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(node) of the sets that meet another one on a word (key, unit) of coarse
    sketches, without sets that cannot have a partner by `known` (node, need_own,
    need_above)."""
    held = _held(keys)
    needs = F.array(
        F.struct(F.col("node").alias("unit"), F.col("need_own").alias("need")),
        F.struct((F.col("node") + 1).alias("unit"), F.col("need_above").alias("need")),
    )
    needs = known.select(F.explode(needs).alias("u")).select("u.*").where("need is not null").distinct()
    able = (
        held.groupBy("unit")
        .agg(F.count("*").alias("own"))
        .join(needs, "unit")
        .where("own >= need")
        .select("unit", F.expr("own - greatest(need, 1) + 1").alias("first"))
    )
    met = stored(_rarest(held, able).select("key", _node_of("unit")), "rare-keys")
    return cut(_of_several(met).select("node").distinct())


def _by_bits(keys: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, lone, small): bits (key, unit) of fine sketches on which all
    partners meet at least once. `known` has (node, n). Two sets share at least
    percent / 100 of the larger and 2 * percent / (100 + percent) of the smaller
    one, so as the smaller of two a set needs fewer of its rarest bits: `small`
    marks these. `lone` is the number of bits that no other set has."""
    held = _held(keys)
    own = held.groupBy("unit").agg(F.count("*").alias("own")).withColumn("node", _node_of("unit"))
    able = own.join(known, "node").select(
        "unit",
        "n",
        (F.col("n") - F.col("own")).alias("lone"),
        (F.col("own") - F.ceil(percent * F.col("n") / 100) + 1).alias("first"),
        (F.col("own") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1).alias("first_small"),
    )
    met = _rarest(held, able.where("first > 0"))
    met = met.select("key", _node_of("unit"), "n", "lone", (F.col("place") <= F.col("first_small")).alias("small"))
    return _of_several(stored(met, "rare-keys"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - F.col("common")
    return both.withColumn("common", common).where(100 * F.col("common") >= percent * union).select("a", "b")


def _classes(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) for the sets that have links to other sets."""
    spark = met.sparkSession
    live_rounds, link_rounds = Rounds(spark, "meeting"), Rounds(spark, "links")
    links, roots, fresh, hubs_of_key, round_ = None, None, False, 1, 0
    live = met.withColumn("root", F.col("node"))
    while True:
        # Keys of one class are done, and a set that is not `small` has only
        # smaller partners that are.
        keys = live.groupBy("key").agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.min(F.when(F.col("small"), F.col("n"))).alias("least"),
        )
        live = live_rounds.put(
            live.join(keys.where("low < high and least is not null").select("key", "least"), "key")
            .where("small or n > least")
            .drop("least")
        )
        if live.isEmpty():
            # Links found since the last contraction join classes as well.
            return stored(connected_components(links), "roots") if fresh else roots
        # Hubs: the set with the fewest lone bits in each of a few parts of a key.
        part = F.pmod(F.xxhash64("node", F.lit(round_)), F.lit(hubs_of_key))
        about = ("lone", "node", "root", "n", "small")
        hubs = cut(
            live.groupBy("key", part.alias("part"))
            .agg(F.min(F.struct(*about)).alias("h"))
            .select("key", *[F.col(f"h.{c}").alias(f"hub_{c}") for c in about])
        )
        pairs = (
            live.join(hubs, "key")
            .where("root <> hub_root")
            .where("(n > hub_n or small) and (hub_n > n or hub_small)")
            # What two partners share at least, they do not hold alone.
            .withColumn("both", percent * (F.col("n") + F.col("hub_n")) / (100 + percent))
            .where("least(n, hub_n) >= both and n - lone >= both and hub_n - hub_lone >= both")
            .select(F.greatest("node", "hub_node").alias("a"), F.least("node", "hub_node").alias("b"))
            .distinct()
        )
        found = _verified(cut(pairs), sets, percent)
        found = found if links is None else links.unionByName(found).distinct()
        links = link_rounds.put(found)
        gone = hubs.select("key", F.col("hub_node").alias("node"))
        live = live.join(gone, ["key", "node"], "left_anti").drop("root")
        fresh = not links.isEmpty()
        if fresh and round_ == 0:
            # One class for dense groups; later links are few.
            roots, fresh = stored(connected_components(links), "roots"), False
        if roots is None:
            live = live.withColumn("root", F.col("node"))
        else:
            live = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        hubs_of_key, round_ = min(MOST_HUBS, hubs_of_key * MORE_HUBS), round_ + 1


def similar_sets(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    n_shingles is the number of different shingles of `size` words; documents
    link when 100 * intersection >= percent * union, and component_id is the
    smallest doc_id reachable over links, itself included. A null or empty text
    has no shingle and is linked with nothing. Repeated rows each give a row; a
    null doc_id is kept and never is the smallest. An empty table gives an empty
    result; other columns are not read. Links within a class that others already
    join are not looked for. A very long text is split in pieces and takes some
    forty bytes a word in its task. Sets go by a name of 63 bits.
    """
    # Texts are read once for all sketches; these are written by column, and what
    # follows reads those it needs.
    summed = docs.select("doc_id", summaries(F.col("text"), size, percent).alias("s"))
    rows = stored(summed.select("doc_id", "s.*"), "summaries")
    keys = _coarse_keys(rows)
    rows = rows.drop("keys_own", "keys_above")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    wanted = _by_words(keys, rows.drop("doc_id", "n"))
    sets = _needed_sets(docs, rows, wanted, size)
    met = _by_bits(_fine_keys(sets, percent), sets.select("node", F.size("members").alias("n")), percent)
    roots = _classes(met, sets, percent)
    if roots is None:
        classes = nodes.select("node", F.col("least").alias("joint"))
    else:
        reached = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        joint = reached.groupBy("root").agg(F.min("least").alias("joint"))
        classes = reached.join(joint, "root").select("node", "joint")
    # Written, so that a set that very many documents have can be dealt out.
    classes = stored(classes, "classes")
    return rows.join(classes, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("joint")).alias("component_id"),
    )


def _needed_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, members) of the sets in `wanted` (node), written once."""
    ids = rows.join(wanted, "node", "left_semi")
    ids = cut(ids.groupBy("node").agg(F.min("doc_id").alias("_id")).select("_id").distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    texts = docs.select("doc_id", "text")
    known = texts.join(ids, texts["doc_id"] == ids["_id"], "left_semi")
    # A set that only documents without an id have cannot be found by one.
    texts = known.unionByName(texts.where("doc_id is null")).select(_sets(F.col("text"), size).alias("s"))
    sets = texts.select("s.*").join(wanted, "node", "left_semi")
    return stored(sets.groupBy("node").agg(F.first("members").alias("members")), "sets")


@corpus_query("op11_parity_join")
def op11_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_sets(table(spark, folder, "documents"))
