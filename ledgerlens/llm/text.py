"""Arrow text columns as numpy byte arrays: words, hashes and sums per document.

Everything works on whole texts, a block of documents at a time. A block holds
about BLOCK_BYTES of text, or one document if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SMALL_BLOCK = 1 << 18  # for arrays of 64 bits a byte that two workers of an executor hold at once
# An odd multiplier has an inverse modulo 2**64, so a slice of prefix sums can be moved to position 0.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values; a bijection."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size - 1) modulo 2**64; the longest table so far is kept."""
    if len(_POWERS.get(base, ())) < size:
        steps = np.full(max(size, BLOCK_BYTES + 2), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:size]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for every i; 0 for an empty slice."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64) if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Block:
    """Documents first .. first + n of a batch: their bytes end to end, offsets[i] where document i starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and word_offsets as `offsets` is for bytes."""
        inside = ~IS_SPACE[self.data]
        edges = np.zeros(len(inside) + 1, bool)  # edges[p]: no word runs across position p
        edges[self.offsets] = True
        before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
        starts = np.flatnonzero(inside & (~before | edges[:-1]))
        after = np.concatenate((inside[1:], [False])) if len(inside) else inside
        ends = np.flatnonzero(inside & (~after | edges[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, fold: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word's bytes, mapped by the table `fold` first."""
        starts, ends, _ = self.words
        return slice_hashes(self.data if fold is None else fold[self.data], starts, ends)


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[starts[i]:ends[i]] for every i, equal slices alike wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, max(1, len(data)))[: len(data)], out=total[1:])
    back = powers(BASE_INVERSE, len(data) + 1)
    return mix64((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The whole column, null as empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1)
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last
