"""Word shingles of whole texts as sorted 64-bit numbers, worked out with numpy inside tasks.

Words are runs of characters other than space and the control characters 9 to 13, after
lower-casing A-Z. A shingle is ``width`` words in a row; a text with fewer words is one shingle,
and a text without words has none. Equal shingles have equal numbers; two different shingles
share one by chance in 2**64.
"""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _random_table() -> np.ndarray:
    table = np.random.default_rng(20240101).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
    table[65:91] = table[97:123]  # A-Z count as a-z
    return table


LETTERS = _random_table()
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as texts ask for them."""

    def __init__(self) -> None:
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(2 * self.size, n, 1 << 15)
            self.up = self._series(BASE)
            self.down = self._series(INVERSE)
        return self.up[:n], self.down

    def _series(self, base: int) -> np.ndarray:
        steps = np.full(self.size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: bytes) -> np.ndarray:
    """One number per word, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    gap = SEPARATORS[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    if not gap[-1]:
        edge = np.append(edge, len(raw))
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers.upto(len(raw))
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(LETTERS[raw] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """The set of shingles, sorted."""
    words = word_hashes(text or b"")
    count = len(words) - width + 1
    if not len(words):
        return words
    if count < 1:
        parts, count = [words[i : i + 1] for i in range(len(words))], 1
    else:
        parts = [words[i : i + count] for i in range(width)]
    value = np.full(count, len(parts), dtype=np.uint64)
    for part in parts:
        value = mixed(value * np.uint64(BASE) + part)
    return np.unique(value)
