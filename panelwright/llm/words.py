"""Words of a run of texts as numpy arrays of 64-bit hashes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import xxhash

OFFSET, PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)
PREFIX = 5  # bytes of a word that `prefixes` tells apart
SHORT = 48  # bytes of a word that are hashed in array steps; longer words singly

# A word is a run of ASCII letters and digits and of any other non-ASCII byte.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    WORD_BYTE[_c] = True


# Letters of scripts that put no space between words.
_UNSPACED = (
    "\u0e01-\u0e4e\u0e81-\u0ece\u0f40-\u0fbc\u1000-\u1049\u1050-\u109d\u1780-\u17d3\u3005-\u3007\u3021-\u3029"
    "\u3041-\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\u9fff\ua000-\ua48c\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)


_UNSPACED_LETTER = re.compile(f"[{_UNSPACED}]")
INVISIBLE = frozenset("\u00ad\u2060\ufeff")  # soft hyphen, word joiner, byte order mark


@lru_cache(1 << 16)
def _spaced(char: str) -> str:
    if char.isascii():
        return char
    if char in INVISIBLE:
        return ""
    if _UNSPACED_LETTER.match(char):
        return f" {char} "
    return " " if unicodedata.category(char)[0] in "ZPS" or char in "\x85\u200b" else char


def apart(text: str) -> str:
    """The text with a space for every non-ASCII space, punctuation mark or
    symbol, and spaces around letters of scripts that have none between words."""
    if text.isascii():
        return text
    changed = {ord(c): _spaced(c) for c in set(text) if _spaced(c) != c}
    return text.translate(changed) if changed else text


class Words(NamedTuple):
    hashes: np.ndarray  # uint64 of every word, text after text
    prefixes: np.ndarray  # the same of the word's first bytes
    sizes: np.ndarray  # words of each text
    starts: np.ndarray  # byte offsets in the lower-cased texts, joined by \n
    ends: np.ndarray
    buffer: bytes

    def word(self, i: int) -> bytes:
        return self.buffer[self.starts[i] : self.ends[i]]


def words_of(texts: Sequence[str]) -> Words:
    """Split lower-cased texts into words. A null text must come as empty."""
    rows = [t.lower().encode("utf-8", "replace") for t in texts]
    buffer = b"\n".join([*rows, b""])
    data = np.frombuffer(buffer, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = WORD_BYTE[data]
    turns = np.flatnonzero(np.diff(inside))
    starts, ends = turns[::2], turns[1::2]
    row_ends = np.cumsum(np.fromiter((len(r) + 1 for r in rows), np.int64, len(rows)))
    upto = np.searchsorted(starts, row_ends)
    return Words(*_hashes(data, starts, ends), np.diff(upto, prepend=0), starts, ends, buffer)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, begun = np.full(len(starts), OFFSET), np.full(len(starts), OFFSET)
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, 255).astype(np.int16), kind="stable")
    first, left = starts[order], -sizes[order]
    h = np.full(len(order), OFFSET)
    for k in range(min(SHORT, int(sizes.max(initial=0)))):
        live = int(np.searchsorted(left, -k))  # words of more than k bytes come first
        h[:live] = (h[:live] ^ data[first[:live] + k]) * PRIME
        if k < PREFIX:
            begun[order] = h
    out[order] = h
    for i in np.flatnonzero(sizes > SHORT).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out, begun
