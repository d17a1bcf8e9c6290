"""Acyclic automata that map n-grams of one length to counts.

A state stands for a common beginning of the n-grams and its arcs for the words that may follow;
the last arc carries the count. Words are 64-bit labels. Arcs of a level lie in one sorted array,
so building, summing and looking up are array operations over all n-grams at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _changes(grams: np.ndarray) -> np.ndarray:
    """For each n-gram and level, whether its beginning up to there differs from the one before."""
    new = np.ones(grams.shape, dtype=bool)
    new[1:] = np.logical_or.accumulate(grams[1:] != grams[:-1], axis=1)
    return new


class CountAutomaton:
    """``arcs[d]``: labels of level d; ``first[d]``: where each state's arcs begin, and the end; ``counts`` of the last arcs."""

    def __init__(self, arcs: list[np.ndarray], first: list[np.ndarray], counts: np.ndarray):
        self.arcs, self.first, self.counts = arcs, first, counts

    @classmethod
    def build(cls, grams: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """From sorted, different n-grams: each adds the arcs in which it differs from the one before."""
        new = _changes(grams)
        arcs, first = [], [np.array([0, int(new[:, 0].sum())])]
        for level in range(grams.shape[1]):
            arcs.append(grams[new[:, level], level])
            if level + 1 < grams.shape[1]:
                number = np.cumsum(new[:, level + 1])
                starts = number[new[:, level]] - 1
                first.append(np.append(starts, number[-1] if len(number) else 0))
        return cls(arcs, first, counts)

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray, sums: bool = True) -> CountAutomaton:
        """From n-grams in any order; counts of equal ones are added up, or else their largest is taken."""
        order = np.lexsort(grams.T[::-1])
        grams, counts = grams[order], counts[order]
        starts = np.flatnonzero(_changes(grams)[:, -1])
        if not len(starts):
            return cls.build(grams, counts)
        return cls.build(grams[starts], (np.add if sums else np.maximum).reduceat(counts, starts))

    def __len__(self) -> int:
        return len(self.counts)

    def grams(self) -> np.ndarray:
        """All n-grams, sorted."""
        columns = []
        spread = np.arange(len(self.counts))
        for level in reversed(range(len(self.arcs))):
            columns.append(self.arcs[level][spread])
            spread = np.searchsorted(self.first[level], spread, side="right") - 1
        return np.stack(columns[::-1], axis=1)

    def kept(self, least: int) -> CountAutomaton:
        """Without the n-grams below a count."""
        large = self.counts >= least
        return CountAutomaton.build(self.grams()[large], self.counts[large])

    def lookup(self, parts: np.ndarray) -> np.ndarray:
        """Counts of the n-grams in the rows of a matrix, 0 for those that are not there.

        All rows go down the levels together; at each they search the arcs of their own state.
        """
        state, found = np.zeros(len(parts), dtype=np.int64), np.ones(len(parts), dtype=bool)
        for level, (arcs, first) in enumerate(zip(self.arcs, self.first)):
            low, high = first[state], first[state + 1]
            end = high.copy()
            while (open_ := low < high).any():
                middle = (low + high) >> 1
                below = open_ & (arcs[np.minimum(middle, len(arcs) - 1)] < parts[:, level])
                low = np.where(below, middle + 1, low)
                high = np.where(open_ & ~below, middle, high)
            here = np.minimum(low, max(len(arcs) - 1, 0))
            found &= (low < end) & (arcs[here] == parts[:, level]) if len(arcs) else False
            state = np.where(found, here, 0)
            if not len(arcs):
                break
        return np.where(found, self.counts[state], 0) if len(self.counts) else np.zeros(len(parts), np.int64)

    def pack(self) -> bytes:
        """Sizes of the levels, labels, number of arcs per state and counts, the latter two as narrow as they can be."""
        degrees = [np.diff(f) for f in self.first[1:]]
        narrow = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in (*degrees, self.counts)]
        head = [len(self.arcs), *[len(a) for a in self.arcs], *[a.itemsize for a in narrow]]
        return b"".join([np.array(head, np.int64).tobytes(), *[a.tobytes() for a in (*self.arcs, *narrow)]])

    @classmethod
    def unpack(cls, data: bytes) -> CountAutomaton:
        depth = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64, 2 * depth, 8).tolist()
        sizes, widths, at = head[:depth], head[depth:], 8 + 16 * depth
        arcs, narrow = [], []
        for size in sizes:
            arcs.append(np.frombuffer(data, np.uint64, size, at))
            at += 8 * size
        for size, width in zip([*sizes[:-1], sizes[-1]], widths):
            narrow.append(np.frombuffer(data, f"u{width}", size, at).astype(np.int64))
            at += size * width
        first = [np.array([0, sizes[0]]), *[np.append(0, np.cumsum(d)) for d in narrow[:-1]]]
        return cls(arcs, first, narrow[-1])


def union(automata: Sequence[CountAutomaton]) -> CountAutomaton:
    """The n-grams of all, counts added up."""
    if len(automata) == 1:
        return automata[0]
    return CountAutomaton.of(
        np.concatenate([a.grams() for a in automata]), np.concatenate([a.counts for a in automata])
    )
