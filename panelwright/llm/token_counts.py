"""Token counts of a unigram vocabulary by dynamic programming over a trie.

The distinct pre-tokens of a batch are put into one trie, level by level. The
best score of a prefix is computed once, at its node, from the nodes of its
ancestors, for all nodes of a level at a time; a pre-token's count stands at
the node where it ends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.base import corpus_query, shared, table
from panelwright.llm.hashing import KeyTable, coded

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
OFFSET, PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)
ZIPF_SHIFT = 2.7


class Pieces:
    """Vocabulary pieces and their log-probabilities, by the hash of the piece
    read from its end. Built on the driver, then broadcast.

    The vocabulary file orders pieces by use but has no probabilities; by Zipf's
    rule the piece at place r has log-probability -log(r + 2.7). A character
    that no piece covers is its UTF-8 bytes, each as unlikely as a piece behind
    the last.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores))
        self.fallback = min(scores.values()) - 1.0
        keys = np.array([_from_end(p) for p in scores], np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one hash")
        self.table = KeyTable(keys, np.arange(len(keys)))
        self.logs = np.array(list(scores.values()))

    @classmethod
    def read(cls, path: str) -> "Pieces":
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        return cls({p: -float(np.log(r + ZIPF_SHIFT)) for r, p in enumerate(kept)})

    def counts(self, words: Sequence[str]) -> np.ndarray:
        """Number of pieces of the most likely split of each word; of equally
        likely splits the one with the fewest pieces."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        starts = np.cumsum(sizes) - sizes
        # Node 0 is the root; the arrays grow by one level at a time.
        parent, char = [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)]
        score, pieces = np.zeros(1), np.zeros(1, np.int64)
        up, last = np.zeros(1, np.int64), np.zeros(1, np.uint64)
        at = np.zeros(len(words), np.int64)
        live = np.flatnonzero(sizes > 0)
        depth, total = 0, 1
        while len(live):
            step = (at[live].astype(np.uint64) << np.uint64(21)) | chars[starts[live] + depth]
            edges, place = np.unique(step, return_inverse=True)
            at[live] = total + place
            parent.append((edges >> np.uint64(21)).astype(np.int64))
            char.append(edges & np.uint64((1 << 21) - 1))
            up, last = _grown(up, parent[-1], total), _grown(last, char[-1], total)
            best, fewest = self._level(up, last, score, pieces, total, len(edges), depth + 1)
            score, pieces = _grown(score, best, total), _grown(pieces, fewest, total)
            total += len(edges)
            depth += 1
            live = live[sizes[live] > depth]
        return pieces[at]

    def _level(self, up, last, score, pieces, total: int, size: int, depth: int):
        """Forward scores and piece counts of the nodes total ... total + size."""
        node = np.arange(total, total + size)
        above = up[node]
        octets = 1 + (last[node] > 0x7F) + (last[node] > 0x7FF) + (last[node] > 0xFFFF)
        best = score[above] + self.fallback * octets
        fewest = pieces[above] + octets
        hashed = np.full(size, OFFSET)
        for _ in range(min(depth, self.longest)):
            hashed = (hashed ^ last[node]) * PRIME + np.uint64(1)
            node = up[node]
            found = self.table.find(hashed)
            hit = np.flatnonzero(found >= 0)
            value = score[node[hit]] + self.logs[found[hit]]
            number = pieces[node[hit]] + 1
            better = (value > best[hit]) | ((value == best[hit]) & (number < fewest[hit]))
            best[hit[better]], fewest[hit[better]] = value[better], number[better]
        return best, fewest


def _grown(kept: np.ndarray, more: np.ndarray, used: int) -> np.ndarray:
    """`kept` with `more` behind its first `used` cells; room doubles."""
    if used + len(more) > len(kept):
        kept = np.resize(kept, max(2 * len(kept), used + len(more)))
    kept[used : used + len(more)] = more
    return kept


def _from_end(piece: str) -> int:
    """Hash over the characters from the last to the first, as in `_level`."""
    h = int(OFFSET)
    for c in reversed(piece):
        h = ((h ^ ord(c)) * int(PRIME) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def pre_tokens(text: str) -> list[str]:
    return [WORD_START + w for w in text.split()]


def token_counts(spark: SparkSession, text: Column, path: str) -> Column:
    """Struct (n_words, n_tokens) of a text: its words between white space, and
    the pieces of their most likely splits. A null or empty text has none."""
    read = shared(spark, Pieces.read(path))

    @F.pandas_udf("n_words long, n_tokens long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = read()
        for batch in batches:
            words, codes, sizes = coded(batch.fillna("").tolist(), pre_tokens)
            counts = vocabulary.counts(words)
            sums = np.concatenate(([0], np.cumsum(counts[codes] if len(codes) else codes)))
            ends = np.cumsum(sizes)
            yield pd.DataFrame({"n_words": sizes, "n_tokens": sums[ends] - sums[ends - sizes]})

    return of(text)


@corpus_query("op10_token_counts")
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts(spark, F.col("text"), public_tokenizers.path(VOCABULARY))
    return table(spark, folder, "documents").select("doc_id", counts.alias("c")).select("doc_id", "c.*")
