"""Distinct word shingles of texts as sorted numpy arrays of 64-bit hashes."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import xxhash

# Odd multiplier of the polynomial that joins the hashes of a shingle's words.
STEP = np.uint64(0x9DDFEA08EB382D69)
# Bytes of one text that are split into words at a time.
PIECE = 4 << 20
# Words of one run whose hashes are remembered at most.
REMEMBERED = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Cut bytes at blanks into pieces of about `size` bytes, so that no list of
    all words of a very long text is held."""
    start = 0
    while len(data) - start > size:
        cut = _BLANK.search(data, start + size)
        if cut is None:
            break
        yield data[start : cut.start()]
        start = cut.start()
    yield data[start:] if start else data


class Hashed(defaultdict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def shingler(size: int) -> Callable[[str | None], np.ndarray]:
    """A function from a text to the sorted hashes of its distinct shingles.

    A-Z are lower-cased and words are runs of anything but [\x20\x09-\x0D]. A
    text of fewer than `size` words, but at least one, has its whole sequence as
    its one shingle; a null text or one without words has none. Hashes have 64
    bits: two different shingles of a pair of texts of a million words each are
    taken for equal with a chance of some 1e-7."""
    known = Hashed()

    def of(text: str | None) -> np.ndarray:
        # bytes.lower() and bytes.split() know A-Z and [\x20\x09-\x0D] only.
        data = text.encode("utf-8", "surrogatepass").lower() if text else b""
        parts = [
            np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            for words in (piece.split() for piece in pieces(data))
        ]
        words = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if not len(words):
            return words
        count = min(size, len(words))
        last = len(words) - count + 1
        joined = np.full(last, np.uint64(count))
        for k in range(count):
            joined = joined * STEP + words[k : k + last]
        # As np.unique, which fills a hash table first and takes longer.
        hashes = np.sort(mixed(joined))
        return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]

    return of


def digest(hashes: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def batches(texts: Sequence, limit: int) -> Iterator[slice]:
    """Runs of rows of at most `limit` characters or members, or one row."""
    start = size = 0
    for i, text in enumerate(texts):
        more = 0 if text is None else len(text)
        if i > start and size + more > limit:
            yield slice(start, i)
            start, size = i, 0
        size += more
    if start < len(texts):
        yield slice(start, len(texts))
