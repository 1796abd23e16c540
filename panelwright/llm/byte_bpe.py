"""Byte-level BPE by ranks: encoding in numpy matrices, and decoding.

Pre-tokens that are alike are encoded once per batch. They are put into padded
matrices by length, one row each; in each round every row merges its leftmost
pair of minimum rank, closes the gap, and looks up the two pairs that are new.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.base import corpus_query, passes, shared, table
from panelwright.llm.hashing import KeyTable, coded, ranges

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(np.iinfo(np.int32).max)
# Pre-tokens of more bytes are merged one by one over a heap: a matrix row
# would cost the square of its length.
MATRIX_BYTES = 256
# Matrices of up to this many cells at a time.
MATRIX_CELLS = 1 << 21
DECODED_ROWS = 256  # texts decoded before they are handed on


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merges:
    """What encoding needs of a rank file; built on the driver, then broadcast
    (a few MB for 50 000 ranks)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        pairs = [
            (ranks[piece[:i]], ranks[piece[i:]], rank)
            for piece, rank in ranks.items()
            for i in range(1, len(piece))
            if piece[:i] in ranks and piece[i:] in ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.table = KeyTable(_pair(left, right), rank)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged pair, NONE where it has none or a side is -1."""
        ranks = np.full(len(left), NONE, np.int32)
        real = np.flatnonzero((left >= 0) & (right >= 0))
        found = self.table.find(_pair(left[real], right[real]))
        ranks[real] = np.where(found >= 0, found, NONE)
        return ranks

    def encode(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        whole = [self.ranks.get(w, -1) for w in words]
        known = np.array(whole, np.int64) >= 0
        for i in np.flatnonzero(known):
            out[i] = whole[i : i + 1]
        for i in np.flatnonzero(~known & (sizes > MATRIX_BYTES)):
            out[i] = self._by_heap(words[i])
        rest = np.flatnonzero(~known & (sizes <= MATRIX_BYTES))
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        start = 0
        while start < len(rest):
            # A bucket: lengths up to a quarter above the shortest, so that
            # little of a matrix is padding.
            width = int(sizes[rest[start]] * 5 // 4)
            end = int(np.searchsorted(sizes[rest], width, "right"))
            end = min(end, start + max(1, MATRIX_CELLS // width))
            self._by_matrix(words, rest[start:end], out)
            start = end
        lens = np.fromiter(map(len, out), np.int64, len(out))
        flat = np.fromiter((i for ids in out for i in ids), np.int32, int(lens.sum()))
        return flat, lens

    def _by_matrix(self, words: Sequence[bytes], rows: np.ndarray, out: list) -> None:
        sizes = np.array([len(words[i]) for i in rows])
        width = int(sizes.max())
        cells = np.full((len(rows), width), -1, np.int32)
        joined = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8)
        cells[np.arange(width) < sizes[:, None]] = self.bytes[joined]
        ranks = self.rank_of(cells[:, :-1].ravel(), cells[:, 1:].ravel())
        ranks = ranks.reshape(len(rows), width - 1)
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                for i, ids in zip(rows[done].tolist(), cells[done].tolist()):
                    out[i] = ids[: ids.index(-1)] if ids[-1] < 0 else ids
                live = ~done
                rows, cells, ranks = rows[live], cells[live], ranks[live]
                at, best = at[live], best[live]
                if not len(rows):
                    return
            line = np.arange(len(rows))
            # The left cell of the pair becomes the merged one, and all cells
            # and ranks to its right move one place to the left.
            cells[line, at] = best
            columns = np.arange(cells.shape[1] - 1)
            cells = np.take_along_axis(cells, columns + (columns > at[:, None]), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            if not len(columns):
                continue
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.rank_of(cells[left, at[left] - 1], cells[left, at[left]])
            right = np.flatnonzero(at < len(columns))
            ranks[right, at[right]] = self.rank_of(cells[right, at[right]], cells[right, at[right] + 1])

    def _by_heap(self, word: bytes) -> list[int]:
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        first = self.rank_of(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32))
        heap = [(int(r), i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pieces, ranks, end = self.pieces, self.ranks, len(ids)

        def push(i: int) -> None:
            if i >= 0 and after[i] < end:
                rank = ranks.get(pieces[ids[i]] + pieces[ids[after[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else end
            if j >= end or ranks.get(pieces[ids[i]] + pieces[ids[j]]) != rank:
                continue  # the pair has changed since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            push(before[i])
            push(i)
        return [i for i in ids if i >= 0]


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def encode(spark: SparkSession, text: Column, path: str, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The ids of a text as binary: little-endian unsigned 32-bit integers.

    Every match of the pattern is encoded on its own, over the whole text, with
    no special tokens. A null or empty text has no ids. `path` is the rank file
    on the driver."""
    read = shared(spark, Merges(read_ranks(path), pattern))

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges = read()
        split = regex.compile(merges.pattern).findall
        for batch in batches:
            texts = batch.fillna("").tolist()
            # A series per pass, so that no whole batch of ids is held.
            for part in passes(texts):
                words, codes, sizes = coded(texts[part], split)
                flat, lens = merges.encode([w.encode() for w in words])
                starts = np.cumsum(lens) - lens
                ids = flat[ranges(starts[codes], lens[codes])].astype("<u4").tobytes()
                ends = np.concatenate(([0], np.cumsum(lens[codes])))[np.cumsum(sizes)].tolist()
                yield pd.Series([ids[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends)], dtype=object)

    return of(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """The bytes that `ids` (binary, as of `encode`) stand for; null for null.
    An id that the vocabulary lacks fails."""
    read = shared(spark, {rank: piece for piece, rank in read_ranks(path).items()})

    @F.pandas_udf("binary")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by_rank = read()

        def whole(part: bytes | None) -> bytes | None:
            if part is None:
                return None
            return b"".join(map(by_rank.__getitem__, np.frombuffer(part, "<u4").tolist()))

        for batch in batches:
            for i in range(0, len(batch), DECODED_ROWS):
                yield pd.Series(list(map(whole, batch.iloc[i : i + DECODED_ROWS])), dtype=object)

    return of(ids)


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


@corpus_query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, folder, "documents").select("doc_id", encode(spark, F.col("text"), path).alias("ids"))
    return docs.select(
        "doc_id",
        n_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode(spark, F.col("ids"), path), 256).alias("decoded_sha256"),
    )
