"""Words of many texts at once, as arrays: where they stand and a 64-bit hash of each.

A hash is a polynomial in the word's bytes, modulo 2^64, taken from running sums over the whole run of texts, so no step
loops over words. Equal words have equal hashes, and so do some others that are easy to find; whoever needs certainty compares
the bytes. ``strong`` hashes have no such others that are easy to find; they are worked out once for every distinct word of the run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from tablemend.llm.common import ship

ship(__name__)

#: Bytes of text that are worked on at a time; a longer text is taken alone. And bytes that are hashed at a time, with
#: arrays of about 40 bytes for each; a longer word is taken alone.
RUN_BYTES = 2_000_000
HASH_BYTES = 500_000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: White space, punctuation and control characters of ASCII.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SMALL = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        row = np.full(max(n, HASH_BYTES + 4096), base, dtype=np.uint64)
        row[0] = 1
        known = np.cumprod(row, dtype=np.uint64)
        if len(known) <= 4 * HASH_BYTES:
            _POWERS[base] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """``data`` holds all texts; word ``i`` is ``data[starts[i]:ends[i]]``; text ``t`` has the words ``first[t]`` to ``first[t+1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)


strong_hash = xxhash.xxh3_64_intdigest


def words_of(
    texts: Sequence[str | bytes], separators: np.ndarray = WHITE, small: bool = False, strong: bool = False
) -> Words:
    """All words of the texts. ``small`` makes A to Z small before hashing."""
    raw = [t.encode() if isinstance(t, str) else t for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    if small:
        data = SMALL[data]
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = separators[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[0::2], edge[1::2]
    text_starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    first = np.searchsorted(starts, text_starts)
    if strong:
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        letters = pa.py_buffer(data[~separators[data]])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), letters])
        coded = coded.dictionary_encode()
        table = np.array([strong_hash(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
        return Words(data, starts, ends, first, table[coded.indices.to_numpy()])
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + HASH_BYTES, side="right")))
        n = int(ends[j - 1] - low)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data[low : low + n].astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
        begin = starts[i:j] - low
        hashes[i:j] = (sums[ends[i:j] - low] - sums[begin]) * powers(INVERSE, n + 1)[begin]
        i = j
    return Words(data, starts, ends, first, mixed(hashes))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` hashes in a row; the order matters. Gives ``len(hashes) - n + 1`` values."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + size]
    return mixed(out)


def runs(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together stay below ``RUN_BYTES`` letters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > RUN_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
