"""Benchmark passages in documents, by CGK embedding and bit-sampling LSH.

Symbols are words. The CGK embedding walks over a word sequence: at each step
it writes the current word, then a random bit of (step, word) tells whether it
moves on. Sequences at a small edit distance fall into step again after an
edit, so edit distance becomes Hamming distance between the walks. Each table
samples a few places of the walk; a window and an item that agree on all of
them meet, and the exact edit distance decides.

The longer an item, the rarer do two of its passages at the threshold agree on
sampled places. Items of more than PART words are therefore cut into parts. The
edits of a passage add up over its parts, so some part is at least as similar as
the whole; where a part meets, the whole item is aligned with the text around.

Windows are as long as the part and start at every word of every document.
Before the walk, a window must hold as many word pairs of the benchmark as a
passage of the threshold's similarity needs (`least_shared`); the count loses
no match and spares most windows the walk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.base import corpus_query, passes, shared, table
from panelwright.llm.hashing import MIX, KeyTable, ranges
from panelwright.llm.words import apart, words_of

SIMILARITY = 0.8  # of words: 1 - edit distance / length of the longer side
# Independent walks, and tables of PLACES sampled places on each.
WALKS, TABLES, PLACES = 6, 16, 3
PART = 64  # words of an item's part at most
SEED = 7
# Words of the benchmark that are held at a time; a larger benchmark is applied
# in parts, one pass over the documents each.
PART_WORDS = 1_000_000
PASS_CHARS = 4 << 20
WINDOWS_AT_ONCE, PAIRS_AT_ONCE = 1 << 15, 1 << 12
PAD = np.uint64(0)
COSTS = 10_000  # units of an edit in `_aligned`


class Benchmark:
    """Items of one part with their LSH tables; built on the driver from at
    most PART_WORDS words, then broadcast."""

    def __init__(self, items: Sequence[tuple[int, str]], similarity: float = SIMILARITY) -> None:
        found = words_of([apart(text or "") for _, text in items])
        bounds = np.cumsum(found.sizes)
        kept = np.flatnonzero(found.sizes > 0)
        self.similarity = similarity
        self.ids = [items[i][0] for i in kept]
        self.words = [found.hashes[bounds[i] - found.sizes[i] : bounds[i]] for i in kept]
        self.sizes = found.sizes[kept]
        # Parts of about equal size: their items and where they begin in them.
        number = -(-self.sizes // PART)
        self.owner = np.repeat(np.arange(len(kept)), number)
        nth = ranges(np.zeros(len(kept), np.int64), number)
        size, cut = self.sizes[self.owner], number[self.owner]
        self.offset = nth * size // cut
        self.part_sizes = (nth + 1) * size // cut - self.offset
        self.in_parts = cut > 1
        rng = np.random.default_rng(SEED)
        self.salts = rng.integers(1, 1 << 62, WALKS, dtype=np.uint64) | np.uint64(1)
        # A walk passes an item in about two steps a word; windows are keyed by
        # places that depend on their length.
        self.lengths, kind = np.unique(self.part_sizes, return_inverse=True)
        self.places = np.stack(
            [
                [np.sort(rng.choice(max(2 * n, PLACES), PLACES, replace=False)) for _ in range(WALKS * TABLES)]
                for n in self.lengths.tolist()
            ]
        ).reshape(len(self.lengths), WALKS, TABLES, PLACES) if len(kept) else None
        # Which lengths have a part with a certain pair of neighbouring words.
        pairs = [
            _neighbours(self.words[i][a : a + n])
            for i, a, n in zip(self.owner.tolist(), self.offset.tolist(), self.part_sizes.tolist())
        ]
        owner = np.repeat(kind, [len(p) for p in pairs]).astype(np.uint64)
        held = np.unique(np.stack([np.concatenate([*pairs, np.zeros(0, np.uint64)]), owner], 1), axis=0)
        known, self.first_kind, self.n_kinds = np.unique(held[:, 0], return_index=True, return_counts=True)
        self.kinds = held[:, 1].astype(np.int64)
        self.neighbours = KeyTable(known, np.arange(len(known)))
        data = np.concatenate([*self.words, np.zeros(1, np.uint64)])
        starts = (np.cumsum(self.sizes) - self.sizes)[self.owner] + self.offset
        self.tables = [
            _grouped(key) for walk in range(WALKS if len(kept) else 0) for key in self.keys(data, starts, kind, walk).T
        ]

    def keys(self, data, starts, kind, walk: int) -> np.ndarray:
        """A key per window and table of the walk: the words at the table's
        sampled places, the window's length (its place in `lengths`) included."""
        at, end = starts.copy(), np.minimum(starts + self.lengths[kind], len(data))
        places = self.places[kind, walk]
        seen = np.empty((int(places.max()) + 1, len(starts)), np.uint64)
        for step in range(len(seen)):
            word = np.where(at < end, data[np.minimum(at, len(data) - 1)], PAD)
            seen[step] = word
            salt = np.uint64((step + 1) * int(self.salts[walk]) & 0xFFFFFFFFFFFFFFFF)
            coin = (word + salt) * MIX
            coin = (coin ^ (coin >> np.uint64(31))) * MIX
            at += (coin >> np.uint64(63)).astype(np.int64)
        keys = np.broadcast_to(kind.astype(np.uint64)[:, None] + np.uint64(1), places.shape[:2])
        for p in range(PLACES):
            keys = (keys ^ seen[places[:, :, p], np.arange(len(starts))[:, None]]) * MIX
            keys ^= keys >> np.uint64(29)
        return keys


def _grouped(keys: np.ndarray):
    """(table of distinct keys, first part of each, number, parts by key)."""
    order = np.argsort(keys, kind="stable")
    distinct, first, number = np.unique(keys[order], return_index=True, return_counts=True)
    return KeyTable(distinct, np.arange(len(distinct))), first, number, order


def _neighbours(words: np.ndarray) -> np.ndarray:
    """One hash for each pair of neighbouring words."""
    return (words[:-1] * MIX) ^ (words[1:] + (words[:-1] >> np.uint64(7)))


def _prefixes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums s and factors f so that (s[j] - s[i]) * f[i] is a hash of data[i:j]."""
    powers = np.cumprod(np.full(len(data) + 1, MIX))
    back = np.cumprod(np.full(len(data) + 1, np.uint64(pow(int(MIX), -1, 1 << 64))))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[:-1], out=sums[1:])
    return sums, back


def least_shared(size: int, similarity: float) -> int:
    """Word pairs of an item that every passage of at least this similarity
    holds. A substitution or deletion breaks two of the size - 1 pairs, an
    insertion one. A passage of n words takes d <= (1 - s) max(size, n) edits,
    of which n - size at least are insertions if n is larger; either way at
    most 2 (1 - s) size pairs break."""
    return size - 1 - floor(2 * (1 - similarity) * size + 1e-9)


def matches(bench: Benchmark, texts: Sequence[str]) -> list[tuple[int, int, float, int, int]]:
    """(row, item place, similarity, first word, words) of the best passage of
    every item in every text that reaches the similarity."""
    found = words_of([apart(t) for t in texts])
    data = found.hashes
    if not len(data) or not len(bench.ids):
        return []
    ends = np.cumsum(found.sizes)
    row = np.repeat(np.arange(len(texts)), found.sizes)
    place = bench.neighbours.find(_neighbours(data))
    place[row[1:] != row[:-1]] = -1
    held = np.flatnonzero(place >= 0)
    number = bench.n_kinds[place[held]]
    kind_of = bench.kinds[ranges(bench.first_kind[place[held]], number)]
    order = np.argsort(kind_of, kind="stable")
    held, kind_of = np.repeat(held, number)[order], kind_of[order]
    sums, back = _prefixes(data)
    windows, kinds, twins = [], [], {}
    long_kinds = np.unique(bench.part_sizes[bench.in_parts])
    for kind, length in enumerate(bench.lengths.tolist()):
        need = least_shared(length, bench.similarity)
        # Pairs begin in the words of the longest passage but its last.
        span = floor(length / bench.similarity + 1e-9) - 1
        starts = np.arange(len(data))
        if need > 0:
            mine = held[slice(*np.searchsorted(kind_of, (kind, kind + 1)))]
            starts = _dense(mine, need, span, row, ends - found.sizes)
        # Windows of one text that read alike, as in a repeated word, are one.
        stop = np.minimum(starts + span + 1, ends[row[starts]])
        content = (sums[stop] - sums[starts]) * back[starts] + (stop - starts).astype(np.uint64)
        alike = np.stack([row[starts].astype(np.uint64), content], 1)
        _, one, group = np.unique(alike, axis=0, return_index=True, return_inverse=True)
        if length in long_kinds:
            # What stands around them decides for long items: all of them count.
            like = starts[one][group.ravel()]
            twins[length] = np.sort(like), starts[np.argsort(like, kind="stable")]
        starts = starts[one]
        windows.append(starts)
        kinds.append(np.full(len(starts), kind))
    part, start = _candidates(bench, data, np.concatenate(windows), np.concatenate(kinds)).T
    best: dict[tuple[int, int], tuple] = {}

    def keep(item: int, start: int, likeness: float, size: int) -> None:
        key = (int(row[start]), item)
        score = (-likeness, start - int(ends[key[0]] - found.sizes[key[0]]), size)
        if key not in best or score < best[key]:
            best[key] = score

    cut = bench.in_parts[part]
    item, begin = bench.owner[part[~cut]], start[~cut]
    for i in range(0, len(item), PAIRS_AT_ONCE):
        at = slice(i, i + PAIRS_AT_ONCE)
        likeness, size = _verified(bench, data, ends[row[begin[at]]], item[at], begin[at])
        for k in np.flatnonzero(likeness >= bench.similarity - 1e-9).tolist():
            keep(int(item[at][k]), int(begin[at][k]), float(likeness[k]), int(size[k]))
    for whole, low, high in _surroundings(bench, part[cut], start[cut], twins, ends - found.sizes, ends, row):
        likeness, first, size = _aligned(bench.words[whole], data[low:high], bench.similarity)
        if likeness >= bench.similarity - 1e-9:
            keep(whole, low + first, likeness, size)
    return [(r, i, -s[0], s[1], s[2]) for (r, i), s in sorted(best.items())]


def _dense(held, need: int, span: int, row, first) -> np.ndarray:
    """The places p, in order, with at least `need` of the sorted places `held`
    among p ... p + span - 1, all in the text of p."""
    if len(held) < need:
        return held[:0]
    low, high = held[: len(held) - need + 1], held[need - 1 :]
    near = (high - low < span) & (row[low] == row[high])
    low, high = low[near], high[near]
    begin = np.maximum(high - span + 1, first[row[low]])
    return np.unique(ranges(begin, low - begin + 1))


def _candidates(bench: Benchmark, data, starts, kinds) -> np.ndarray:
    """Distinct pairs (part, start) that meet in some table, by part length. A
    walk may pass the end of the window's text; the exact check does not."""
    out = [np.zeros((0, 2), np.int64)]
    for i in range(0, len(starts), WINDOWS_AT_ONCE):
        part = starts[i : i + WINDOWS_AT_ONCE]
        found = []
        for walk in range(WALKS):
            keys = bench.keys(data, part, kinds[i : i + WINDOWS_AT_ONCE], walk)
            for t in range(TABLES):
                known, first, number, members = bench.tables[walk * TABLES + t]
                at = known.find(keys[:, t])
                hit = np.flatnonzero(at >= 0)
                part_of = members[ranges(first[at[hit]], number[at[hit]])]
                found.append(np.stack([part_of, np.repeat(part[hit], number[at[hit]])], 1))
        out.append(np.unique(np.concatenate(found), axis=0))
    pairs = np.concatenate(out)
    return pairs[np.argsort(bench.part_sizes[pairs[:, 0]], kind="stable")]


def _surroundings(bench: Benchmark, part, start, twins, first, ends, row) -> Iterator[tuple[int, int, int]]:
    """(item, first place, place behind the last) of the stretches of text in
    which a passage of the whole item lies if the part begins at the start or at
    a window that reads alike; stretches that overlap are one."""
    found = []
    for p, s in zip(part.tolist(), start.tolist()):
        item, offset = int(bench.owner[p]), int(bench.offset[p])
        longest = floor(int(bench.sizes[item]) / bench.similarity + 1e-9)
        slack = longest - int(bench.sizes[item])  # edits of a passage at most
        like, places = twins[int(bench.part_sizes[p])]
        at = places[slice(np.searchsorted(like, s), np.searchsorted(like, s, "right"))]
        low = np.maximum(at - offset - slack, first[row[at]])
        high = np.minimum(at - offset + slack + longest, ends[row[at]])
        found.append(np.stack([np.full(len(at), item), low, high], 1))
    if not found:
        return
    places = np.unique(np.concatenate(found), axis=0).tolist()
    item, low, high = places[0]
    for i, a, b in places[1:]:
        if i == item and a < high:
            high = max(high, b)
        else:
            yield item, low, high
            item, low, high = i, a, b
    yield item, low, high


def _aligned(item: np.ndarray, text: np.ndarray, similarity: float) -> tuple[float, int, int]:
    """Similarity, first word and words of a passage of the text that reaches
    the similarity, if one does, over all begins and ends. Two tables, a row per
    word of the item: the fewest edits e of a passage that ends at a place, and
    the least e - (1 - s) m of one of m words. A passage of n words or less
    reaches s if the first is at most (1 - s) n, a longer one if the second is
    at most 0. Costs carry their passage's begin in the low bits; of equal ones
    the longer passage is taken."""
    bits = int(len(text) + 1).bit_length()
    gain = np.array([[0], [ceil((1 - similarity) * COSTS - 1e-6)]], np.int64)
    one = np.int64(COSTS << bits)
    places = np.arange(len(text) + 1, dtype=np.int64)
    along = places * (one - (gain << bits))
    line = np.broadcast_to(places, (2, len(places)))
    for word in item:
        step = line + one
        moved = line[:, :-1] + np.where(text != word, one, 0) - (gain << bits)
        step[:, 1:] = np.minimum(step[:, 1:], moved)
        # Insertions: the running minimum along the row.
        line = np.minimum.accumulate(step - along, axis=1) + along
    first = line & ((1 << bits) - 1)
    size = places - first
    edits = ((line >> bits) + gain * size) / COSTS
    likeness = 1.0 - edits / np.maximum(size, len(item))
    order = np.lexsort((size.ravel(), first.ravel(), -likeness.ravel()))
    at = order[0]
    return float(likeness.flat[at]), int(first.flat[at]), int(size.flat[at])


def _verified(bench: Benchmark, data, stop, item, start) -> tuple[np.ndarray, np.ndarray]:
    """Best similarity of an item to a passage that begins at `start`, over all
    ends within its text, and the words of that passage: the edit distance of
    all pairs at a time, one row of the table per word of the item."""
    sizes = bench.sizes[item]
    reach = int(np.floor(sizes.max() / bench.similarity + 1e-9))
    columns = np.arange(reach)
    place = start[:, None] + columns
    text = np.where(place < stop[:, None], data[np.minimum(place, len(data) - 1)], PAD)
    words = np.zeros((len(item), int(sizes.max())), np.uint64)
    for i in np.unique(item):
        words[item == i, : bench.sizes[i]] = bench.words[i]
    line = np.broadcast_to(np.arange(reach + 1, dtype=np.int32), (len(item), reach + 1)).copy()
    offset = np.arange(reach + 1, dtype=np.int32)
    for k in range(words.shape[1]):
        step = np.empty_like(line)
        step[:, 0] = k + 1
        step[:, 1:] = np.minimum(line[:, :-1] + (text != words[:, k : k + 1]), line[:, 1:] + 1)
        # Insertions: the running minimum along the row, one more per column.
        step = np.minimum.accumulate(step - offset, axis=1) + offset
        line = np.where((k < sizes)[:, None], step, line)
    length = np.arange(1, reach + 1)
    likeness = 1.0 - line[:, 1:] / np.maximum(length, sizes[:, None])
    likeness = np.where(place < stop[:, None], likeness, -1.0)
    at = likeness.argmax(axis=1)
    return likeness[np.arange(len(item)), at], at + 1


def _parts(benchmark: DataFrame) -> int:
    """Parts that hold PART_WORDS at most on average, by the benchmark's bytes,
    of which a word and what parts it from the next take two at least."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, ceil(size / 2 / PART_WORDS))


def _part(benchmark: DataFrame, part: int, parts: int) -> list[tuple[int, str]]:
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part
    rows = benchmark.where("text is not null").where(mine).select("item_id", "text").distinct()
    return sorted(((r[0], r[1]) for r in rows.collect()), key=lambda r: (r[0] is None, r))


def _shared_parts(spark: SparkSession, benchmark: DataFrame, similarity: float):
    """The benchmark in broadcast parts of bounded size, at least one."""
    parts = _parts(benchmark)
    return [shared(spark, Benchmark(_part(benchmark, part, parts), similarity)) for part in range(parts)]


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id,
    similarity, first_word, n_words of the best passage.

    Words are compared in lower case without punctuation; in scripts without
    spaces every letter is a word. Items and texts that
    are null or have no word match nothing; repeated documents give repeated
    rows; ties go to the passage that begins first. Other columns are not read.
    """
    found = None
    for read in _shared_parts(docs.sparkSession, benchmark, similarity):
        part = docs.select("doc_id", "text").mapInPandas(
            _searching(read), "doc_id long, item_id long, similarity double, first_word long, n_words long"
        )
        found = part if found is None else found.unionByName(part)
    return found


def _searching(read: Callable[[], Benchmark]):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench = read()
        for batch in batches:
            texts, ids = batch["text"].fillna("").tolist(), batch["doc_id"]
            for cut in passes(texts, PASS_CHARS):
                hits = matches(bench, texts[cut])
                yield pd.DataFrame(
                    {
                        "doc_id": ids.iloc[[cut.start + h[0] for h in hits]].to_numpy(),
                        "item_id": pd.Series([bench.ids[h[1]] for h in hits], dtype="Int64"),
                        "similarity": [h[2] for h in hits],
                        "first_word": [h[3] for h in hits],
                        "n_words": [h[4] for h in hits],
                    }
                )

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> Column:
    """Whether the row's text holds some item; a column over `docs`' text."""
    held = F.lit(False)
    for read in _shared_parts(docs.sparkSession, benchmark, similarity):
        held = held | _holding(read)(F.col("text"))
    return held


def _holding(read: Callable[[], Benchmark]):
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bench = read()
        for batch in batches:
            texts = batch.fillna("").tolist()
            out = np.zeros(len(texts), bool)
            for cut in passes(texts, PASS_CHARS):
                out[[cut.start + h[0] for h in matches(bench, texts[cut])]] = True
            yield pd.Series(out)

    return holds


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no passage of the benchmark."""
    return docs.where(~contaminated(docs, benchmark))


@corpus_query("op1_decontamination")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
