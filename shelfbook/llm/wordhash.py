"""Words of whole texts and their 64-bit hashes, for a block of texts at a time, in numpy.

A word is a longest run of bytes other than space and \\t \\n \\v \\f \\r. All hashes are polynomials modulo 2**64
over random tables that are fixed by a seed, so that every task computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # text bytes worked on at once; a longer text makes a block of its own

_random = np.random.default_rng(20_240_229)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = _random.integers(1, 1 << 61, 2, dtype=np.uint64) * np.uint64(8) + np.uint64(5)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as they have been asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = Powers(_BASE[0]), Powers(_BASE[1])


class Block:
    """Texts given as bytes and offsets; ``words`` are their hashes, ``first`` the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        begins, ends = offsets[:-1], offsets[1:]
        filled = begins < ends
        data = _LOWER[data] if lower else data
        solid = ~_SPACE[data]
        start, stop = solid.copy(), solid.copy()
        start[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        at, last = begins[filled], ends[filled] - 1
        start[at], stop[last] = solid[at], solid[last]
        starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
        up, down = _byte_powers.reach(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(np.multiply(values := _BYTE[data], up[:-1], out=values), out=total[1:])
        self.words = mixed((total[stops] - total[starts]) * down[starts])
        self.first = np.searchsorted(starts, offsets)

    def __len__(self) -> int:
        return len(self.first) - 1

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words of one text, in order, and how many each text has."""
        counts = np.maximum(np.diff(self.first) - (k - 1), 0)
        total = np.zeros(len(self.words) + 1, np.uint64)
        up, down = _word_powers.reach(len(self.words) + 1)
        np.cumsum(self.words * up[:-1], out=total[1:])
        begin = np.repeat(self.first[:-1] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return mixed((total[begin + k] - total[begin]) * down[begin]), counts

    def short(self, text: int) -> np.uint64:
        """Hash of all words of a text that has fewer than 64."""
        own = self.words[self.first[text] : self.first[text + 1]]
        return mixed(np.sum(own * _PLACE[: len(own)], dtype=np.uint64)[None] + np.uint64(len(own)))[0]


def blocks(texts: pa.Array, lower: bool = False, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, row after the last, block) over an Arrow array of strings; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        own = offsets[at : to + 1]
        yield at, to, Block(data[own[0] : own[-1]], own - own[0], lower)
        at = to
