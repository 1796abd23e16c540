"""Alignment of the tokens that two tokenizers cut from one text.

Both token lists cover the same bytes, so their sorted end offsets are compared:
the shorter list drives a galloping search into the longer one, that is
exponential steps and then a binary search between the last two. Ends that both
have slice the tokens into groups; differences of ranks give the range of tokens
that each token overlaps, which are the links.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelwright.lineage import cut, stored
from panelwright.llm.base import corpus_query, shared, table
from panelwright.llm.hashing import coded, ranges
from panelwright.llm.shingles import batches

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
# Both tokenizers part a text before a space that follows no white space: byte
# patterns begin a new pre-token there, and no piece goes on over it (checked).
UNIT = re.compile(r"(?<=\S)(?= )")
# Characters of texts per pass, units that are encoded at a time, and rows of
# counts that are broadcast at most (some 40 bytes each).
RUN_CHARS, PART, BROADCAST_ROWS = 2 << 20, 512, 1 << 20
# Units that a task remembers at most (some 300 bytes each), and their characters.
REMEMBERED, LONGEST_REMEMBERED = 1 << 17, 64
# Behind an id: in a run of one side, at its end, at the end of a group, of a unit.
SIGNS = ",|;\n"


def gallop(longer: np.ndarray, shorter: np.ndarray, block: int = 32) -> np.ndarray:
    """For each value of `shorter` the number of values of `longer` below it;
    both are sorted. Every block of `shorter` starts at the place of its first
    value; its others double their steps from there until they have passed, and
    then halve the last step. All values take a step at a time."""
    size = len(longer)
    if not size or not len(shorter):
        return np.zeros(len(shorter), np.int64)
    low = np.repeat(np.searchsorted(longer, shorter[::block]), block)[: len(shorter)].astype(np.int64)
    # longer[low - 1] < value; high is the first place known not to be below.
    high = np.full(len(shorter), size, np.int64)
    step, live = 1, np.arange(len(shorter))
    while len(live):
        probe = low[live] + step - 1
        inside = probe < size
        below = inside & (longer[np.minimum(probe, size - 1)] < shorter[live])
        passed = inside & ~below
        high[live[passed]] = probe[passed]
        live = live[below]
        low[live] = probe[below] + 1
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        below = longer[middle] < shorter[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


class Alignment(NamedTuple):
    group_of_a: np.ndarray  # number of the group of every token
    group_of_b: np.ndarray
    n_groups: int
    first: np.ndarray  # of every token of the shorter list the first token of
    count: np.ndarray  # the other that it overlaps, and how many it overlaps
    driver: str  # which list is the shorter, "a" or "b"

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B that overlap, pair by pair."""
        mine = np.repeat(np.arange(len(self.count)), self.count)
        other = ranges(self.first, self.count)
        return (mine, other) if self.driver == "a" else (other, mine)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Align two token lists by their end offsets, which rise strictly and have
    the last one in common."""
    driver = "a" if len(ends_a) <= len(ends_b) else "b"
    shorter, longer = (ends_a, ends_b) if driver == "a" else (ends_b, ends_a)
    below = gallop(longer, shorter)
    common = longer[np.minimum(below, len(longer) - 1)] == shorter if len(longer) else np.zeros(0, bool)
    # A token starts where the one before it ends: behind the tokens of the
    # other list that end there or before.
    first = np.concatenate(([0], (below + common)[:-1])).astype(np.int64)
    count = below - first + 1
    closes = np.zeros(len(longer), bool)
    closes[below[common]] = True
    of_shorter = np.cumsum(common) - common
    of_longer = np.cumsum(closes) - closes
    of_a, of_b = (of_shorter, of_longer) if driver == "a" else (of_longer, of_shorter)
    return Alignment(of_a, of_b, int(common.sum()), first, count if len(shorter) else first[:0], driver)


def byte_of_char() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for a byte:
    itself where it is visible Latin-1, else the next code point from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Sides:
    """Both tokenizers with the bytes of all their tokens; built on the driver
    and broadcast as the contents of their files, a few MB."""

    def __init__(self, byte_file: bytes, piece_file: bytes) -> None:
        self.bytes_tokenizer = Tokenizer.from_str(byte_file.decode())
        # Strings of special tokens in a text are plain text.
        self.bytes_tokenizer.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        table_ = byte_of_char()
        vocabulary = json.loads(byte_file)["model"]["vocab"]
        self.of_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.of_a[i] = bytes(table_[c] for c in piece)
        self.space = self.pieces.piece_to_id(SPACE)
        self.of_b = [self._piece_bytes(i) for i in range(self.pieces.get_piece_size())]
        # No piece but runs of spaces may hold a space behind another character.
        crosses = any(SPACE in p.lstrip(SPACE) for p in map(self.pieces.id_to_piece, range(len(self.of_b))))
        self.units = None if crosses else UNIT
        self.sizes_a, self.sizes_b = (np.array(list(map(len, of)), np.int64) for of in (self.of_a, self.of_b))
        # Decimal ids with the sign behind them, see `groups_texts`.
        self.written = [f"{i}{sign}" for i in range(max(len(self.of_a), len(self.of_b))) for sign in SIGNS]

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.pieces.is_control(i) or self.pieces.is_unknown(i):
            return b""
        return piece.replace(SPACE, " ").encode()

    def split(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(the different units of the texts, each with a space before it, the
        code of every unit, units per text)."""
        return coded(texts, lambda t: self.units.split(f" {t}") if self.units else [f" {t}"])

    def encoded(self, units: list[str]) -> "Units":
        # Units that end in white space, as only last ones do, might join with
        # what follows and are encoded singly; they go last.
        single = np.array([self.units is None or u[-1].isspace() for u in units], bool)
        order = np.argsort(single, kind="stable")
        units = [units[i] for i in order.tolist()]
        data = [u.encode() for u in units]
        many = len(units) - int(single.sum())
        a = self._side(units, data, many, self._ids_a, self.of_a, self.sizes_a)
        b = self._side(units, data, many, self._ids_b, self.of_b, self.sizes_b)
        found = Units(a[0], a[1], b[0], b[1], a[2] & b[2])
        return found.taken(np.argsort(order, kind="stable")) if single.any() else found

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.bytes_tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        # The model puts a space before each text, which it has already, but
        # none before nothing: a last space is a unit of its own.
        return [ids or [self.space] for ids in self.pieces.encode([t[1:] for t in texts], num_threads=1)]

    @staticmethod
    def _side(units: list[str], data: list[bytes], many: int, ids_of: Callable, pieces: list[bytes], sizes: np.ndarray):
        """(ids of all units in a row, tokens of every unit, whether these give
        the unit's bytes back and none is empty). The first `many` units are
        encoded as texts of PART units. Where the tokens of such a text do not
        give it back or go over the end of a unit, its units are encoded singly."""
        ids, counts, good = [], [], np.ones(len(units), bool)
        edges = [*range(0, many, PART), *range(many, len(units), PART), len(units)]
        for start, stop in zip(edges, edges[1:]):
            part = data[start:stop]
            if start < many:
                (found,) = ids_of(["".join(units[start:stop])])
                row = np.array(found, np.int64)
                # Without an empty token, the unit's last one is where it ends.
                ends, unit_ends = np.cumsum(sizes[row]), np.cumsum(list(map(len, part)))
                last = np.minimum(np.searchsorted(ends, unit_ends), len(ends) - 1)
                parted = (ends[last] == unit_ends).all() and sizes[row].all()
                if parted and b"".join([pieces[i] for i in found]) == b"".join(part):
                    ids.append(row)
                    counts.append(np.diff(last, prepend=-1))
                    continue
            lists = ids_of(units[start:stop])
            counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
            ids.append(np.fromiter(chain.from_iterable(lists), np.int64, int(counts[-1].sum())))
            good[start:stop] = [
                b"".join([pieces[i] for i in one]) == d and all([pieces[i] for i in one]) for d, one in zip(part, lists)
            ]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *ids]), np.concatenate([none, *counts]), good

    def tokens(self, texts: list[str]) -> list[tuple | None]:
        """(ids of A, ends of A, ids of B, ends of B) of every text with a space
        before it; None for a text whose bytes either of them does not give back."""
        different, codes, per_text = self.split(texts)
        units, edge = self.encoded(different), edges(per_text)
        kept = edges(~units.good[codes])[edge]
        sides = []
        for ids, counts, sizes in (
            (units.ids_a, units.counts_a, self.sizes_a),
            (units.ids_b, units.counts_b, self.sizes_b),
        ):
            sides.append((of_runs(ids, counts, codes), edges(counts[codes])[edge], sizes))
        out: list = []
        for i in range(len(texts)):
            if kept[i] != kept[i + 1]:
                out.append(None)
                continue
            own = [(ids[at[i] : at[i + 1]], sizes) for ids, at, sizes in sides]
            out.append(tuple(x for ids, sizes in own for x in (ids, np.cumsum(sizes[ids]))))
        return out


class Units(NamedTuple):
    """Tokens of different units, those of one unit after those of another."""

    ids_a: np.ndarray
    counts_a: np.ndarray  # tokens of every unit
    ids_b: np.ndarray
    counts_b: np.ndarray
    good: np.ndarray  # whether both give the unit's bytes back

    def taken(self, rows: np.ndarray) -> "Units":
        a, b = of_runs(self.ids_a, self.counts_a, rows), of_runs(self.ids_b, self.counts_b, rows)
        return Units(a, self.counts_a[rows], b, self.counts_b[rows], self.good[rows])

    def kept(self) -> "Units":
        """Without the tokens of units that are not good."""
        a, b = np.repeat(self.good, self.counts_a), np.repeat(self.good, self.counts_b)
        return Units(self.ids_a[a], self.counts_a * self.good, self.ids_b[b], self.counts_b * self.good, self.good)


def edges(sizes: np.ndarray) -> np.ndarray:
    """Where each of some runs begins that lie in a row, and the end of the last."""
    return np.concatenate(([0], np.cumsum(sizes)))


def of_runs(flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The runs `rows` of those that lie in a row in `flat`."""
    return flat[ranges(edges(sizes)[rows], sizes[rows])]


def groups_texts(aligned: Alignment, units: Units, written: list[str]) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of every unit: the ids of every group."""
    side = np.repeat([0, 1], [len(units.ids_a), len(units.ids_b)])
    group = np.concatenate((aligned.group_of_a, aligned.group_of_b)) * 2 + side
    order = np.argsort(group, kind="stable")
    group = group[order]
    signs = np.where(np.append(group[1:] != group[:-1], True), side[order] + 1, 0)
    sizes = units.counts_a + units.counts_b
    signs[np.cumsum(sizes)[sizes > 0] - 1] = SIGNS.index("\n")
    texts = (np.concatenate((units.ids_a, units.ids_b))[order] * len(SIGNS) + signs).tolist()
    lines = iter("".join([written[i] for i in texts]).split("\n"))
    return [next(lines) if n else "" for n in sizes.tolist()]


NOTHING = (0, 0, 0, 0, "", [], [])
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a << 32) | b


def alignments(spark: SparkSession, text: Column, byte_path: str, piece_path: str) -> Column:
    """Struct of n_a, n_b, n_groups, n_links, groups_sha256, and the different
    linked id pairs (A << 32 | B) with how many links each has. A null or empty
    text, and one that either tokenizer does not give back, has no tokens. The
    paths are files on the driver. A very long text is aligned at once and takes
    some 200 bytes a token."""
    with open(byte_path, "rb") as a, open(piece_path, "rb") as b:
        files = shared(spark, (a.read(), b.read()))

    @F.pandas_udf(ALIGNED)
    def of(runs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Tasks share the cores already; threads of a tokenizer only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(Sides(*files()))
        for texts in runs:
            rows = [t or "" for t in texts.tolist()]
            # A frame per pass, so that the links of no whole batch are held.
            for run in batches(rows, RUN_CHARS):
                yield pd.DataFrame(aligner.rows(rows[run]), columns=[c.split()[0] for c in ALIGNED.split(", ")])

    return of(text)


class Aligned(NamedTuple):
    """Different units after their alignment."""

    numbers: np.ndarray  # a row per unit: is not good, tokens of A, of B, groups, links
    pairs: np.ndarray  # of the links, unit after unit
    lines: list[str]  # groups of every unit

    def and_(self, other: "Aligned") -> "Aligned":
        return Aligned(*(np.concatenate(x) for x in zip(self[:2], other[:2])), self.lines + other.lines)

    def taken(self, rows: np.ndarray) -> "Aligned":
        pairs = of_runs(self.pairs, self.numbers[:, 4], rows)
        return Aligned(self.numbers[rows], pairs, [self.lines[i] for i in rows.tolist()])


NO_UNITS = Aligned(np.zeros((0, 5), np.int64), np.zeros(0, np.int64), [])


def aligned_units(sides: Sides, different: list[str]) -> Aligned:
    """Tokens of both sides end where a unit does, so that no group and no link
    goes over it and all units are aligned in a row."""
    units = sides.encoded(different).kept()
    aligned = align(np.cumsum(sides.sizes_a[units.ids_a]), np.cumsum(sides.sizes_b[units.ids_b]))
    at_a, at_b = aligned.links()
    edge_a, edge_b = edges(units.counts_a), edges(units.counts_b)
    groups = np.append(aligned.group_of_a, aligned.n_groups)[edge_a]
    # Links lie in the order of the shorter list.
    links = np.searchsorted(at_a, edge_a) if aligned.driver == "a" else np.searchsorted(at_b, edge_b)
    numbers = np.column_stack((~units.good, units.counts_a, units.counts_b, np.diff(groups), np.diff(links)))
    pairs = pair_of(units.ids_a[at_a], units.ids_b[at_b])
    return Aligned(numbers.astype(np.int64), pairs, groups_texts(aligned, units, sides.written))


class Aligner:
    """Rows of texts, put together of their units. Units that a pass has more
    than once are remembered, up to REMEMBERED; then all are forgotten."""

    def __init__(self, sides: Sides) -> None:
        self.sides, self.known, self.aligned = sides, {}, NO_UNITS

    def rows(self, texts: list[str]) -> list[tuple]:
        """A row of ALIGNED for every text."""
        different, codes, per_text = self.sides.split(texts)
        place = np.fromiter((self.known.get(u, -1) for u in different), np.int64, len(different))
        fresh = np.flatnonzero(place < 0)
        new = aligned_units(self.sides, [different[i] for i in fresh.tolist()])
        place[fresh] = len(self.known) + np.arange(len(fresh))
        units, own = self.aligned.and_(new), place[codes]
        edge = edges(per_text)
        sums = np.diff(np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(units.numbers[own], axis=0)))[edge], axis=0)
        link_edge, links = edges(units.numbers[:, 4]), units.numbers[:, 4]
        out = []
        for i, (text, (bad, n_a, n_b, n_groups, n_links)) in enumerate(zip(texts, sums.tolist())):
            if not text or bad:
                out.append(NOTHING)
                continue
            mine = own[edge[i] : edge[i + 1]]
            linked = units.pairs[ranges(link_edge[mine], links[mine])]
            digest = sha256(";".join([units.lines[c] for c in mine.tolist()]).encode()).hexdigest()
            out.append((n_a, n_b, n_groups, n_links, digest, *np.unique(linked, return_counts=True)))
        self._remember(different, fresh, np.bincount(codes, minlength=len(different))[fresh] > 1, new)
        return out

    def _remember(self, different: list[str], fresh: np.ndarray, again: np.ndarray, new: Aligned) -> None:
        again &= np.fromiter((len(different[i]) <= LONGEST_REMEMBERED for i in fresh.tolist()), bool, len(fresh))
        if len(self.known) + int(again.sum()) > REMEMBERED:
            self.known, self.aligned = {}, NO_UNITS
            return
        for i in fresh[again].tolist():
            self.known[different[i]] = len(self.known)
        self.aligned = self.aligned.and_(new.taken(np.flatnonzero(again)))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, docs, best): of every id pair the number of rows that hold it
    linked, and whether that is the highest of its A id."""
    counts = stored(
        rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pair-counts"
    )
    ids = F.shiftright("pair", 32)
    most = counts.groupBy(ids.alias("a")).agg(F.max("docs").alias("most"))
    return cut(
        counts.withColumn("a", ids).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    )


def aligned_tokens(
    spark: SparkSession, docs: DataFrame, byte_path: str, piece_path: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    A pair's count is the number of rows of the table that hold it linked;
    n_best counts the links whose pair has the highest count of its A id (ties
    included), count_sum sums the counts over links. Texts without tokens have
    zeros and an empty digest. Repeated rows and null ids each count as a row; an
    empty table gives no rows; other columns are not read. Counts are broadcast
    where they have at most `broadcast_rows` rows and are joined otherwise.
    """
    rows = docs.select("doc_id", alignments(spark, F.col("text"), byte_path, piece_path).alias("s"))
    rows = stored(rows.select("doc_id", "s.*").withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows)
    counts = F.broadcast(counts) if counts.count() <= broadcast_rows else counts
    # The links of a row lie together, so the partial sums are about one a row.
    sums = (
        rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
        .select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )


@corpus_query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    return aligned_tokens(spark, table(spark, folder, "documents"), path(BYTE_VOCABULARY), path(PIECE_VOCABULARY))
