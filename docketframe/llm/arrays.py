"""Words, hashes and windows of many texts at once, as numpy arrays inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"
MASK40 = np.uint64((1 << 40) - 1)

# Multipliers are 5 modulo 8: their powers stay far from 1, so few bits are lost.
_BYTE_STEP = 0x9E3779B97F4A7C15 & ~7 | 5
_WORD_STEPS = (0xD6E8FEB86659FD93 & ~7 | 5, 0xA0761D6478BD642F & ~7 | 5)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=8)
def _powers(step: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(step: int, n: int) -> np.ndarray:
    """step ** 0 … step ** (n - 1), modulo 2 ** 64."""
    return _powers(step, max(10, int(n).bit_length()))[:n]


#: How to drop what operators keep in a Python worker from one task to the next.
KEPT: list[Callable[[], object]] = [_powers.cache_clear]


def give_back() -> None:
    """Hand memory that is no longer used back to the system, what operators keep included.

    A Python worker is kept for the stages that follow; what its arrays took would stay with it beside them.
    """
    for drop in KEPT:
        drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """A hash of values[start:end] for each span, by prefix sums of a polynomial."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(step, len(values)), out=sums[1:])
    back = pow(step, -1, 1 << 64)
    return mix((sums[ends] - sums[starts]) * powers(back, len(values) + 1)[starts])


#: Bytes of text whose words are hashed at a time, unless one word alone is longer: some 40 bytes are taken for each.
HASHED_BYTES = 1 << 18


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte_values: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, a slice of the text after the other."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASHED_BYTES, side="right")))
        first = starts[at]
        values = byte_values[data[first : ends[to - 1]]]
        out[at:to] = span_hashes(values, starts[at:to] - first, ends[at:to] - first, _BYTE_STEP)
        at = to
    return out


class Words:
    """The words of a batch of texts.

    ``data`` holds the texts, each followed by one white-space byte; ``sizes``
    are their lengths in bytes without it.  ``doc`` is the text of each word,
    ``first`` the number of words before each text (one entry more than texts).
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, word_bytes: np.ndarray, lower: bool = False):
        self.data, self.sizes = data, sizes
        self.bounds = np.concatenate([[0], np.cumsum(sizes + 1)])
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = word_bytes[data]
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(sizes)), self.counts)
        self.hash = _word_hashes(data, self.starts, self.ends, _BYTE_VALUES[_LOWER] if lower else _BYTE_VALUES)

    def __len__(self) -> int:
        return len(self.starts)

    def windows(self, n: int, lane: int = 0) -> np.ndarray:
        """A hash of each run of n words, by its first word; see ``whole``."""
        last = max(0, len(self) - n + 1)
        at = np.arange(last)
        return span_hashes(self.hash, at, at + n, _WORD_STEPS[lane])

    def whole(self, n: int) -> np.ndarray:
        """Which of those runs lie in one text."""
        last = max(0, len(self) - n + 1)
        return self.doc[:last] == self.doc[n - 1 : n - 1 + last]


_LOWER = np.arange(256)
_LOWER[65:91] += 32


def byte_class(*outside: tuple[int, int]) -> np.ndarray:
    """A table of the bytes that belong to words: all but the ranges given."""
    table = np.ones(256, np.int8)
    for low, high in outside:
        table[low : high + 1] = 0
    return table


#: ``[^\x20\x09-\x0D]+``
BLANK_SEPARATED = byte_class((0x20, 0x20), (0x09, 0x0D))


def cover(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of ``length`` from one of the starts."""
    ends = np.minimum(starts + length, n)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def distinct(hi: np.ndarray, lo: np.ndarray | None = None):
    """(index of the first of each distinct key in key order, group of each key, counts)."""
    order = np.argsort(hi, kind="stable") if lo is None else np.lexsort((lo, hi))
    new = np.ones(len(hi), bool)
    new[1:] = hi[order[1:]] != hi[order[:-1]]
    if lo is not None:
        new[1:] |= lo[order[1:]] != lo[order[:-1]]
    group = np.empty(len(hi), np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group, np.bincount(group, minlength=int(new.sum()))


def joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """(texts in UTF-8, each followed by a space; their sizes).  Null counts as empty."""
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(whole):
        return b"", sizes
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    glued = pc.binary_join_element_wise(whole, space, nothing)
    offsets = np.frombuffer(glued.buffers()[1], np.int64)[glued.offset : glued.offset + len(glued) + 1]
    return glued.buffers()[2].to_pybytes()[int(offsets[0]) : int(offsets[-1])], sizes
