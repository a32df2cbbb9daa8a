"""FM-index over a sequence of word symbols."""

from __future__ import annotations

import numpy as np

from regioncast.llm.wavelet import Plane, WaveletMatrix

#: The symbol between runs of words; each separator sorts by its place, so no match crosses one.
SEPARATOR = 0
SAMPLE = 16


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """Place of each suffix in sorted order, by prefix doubling that goes on only in groups of equal prefixes."""
    n = len(symbols)
    separators = np.flatnonzero(symbols == SEPARATOR)
    key = symbols.astype(np.int64) + len(separators)
    key[separators] = np.arange(len(separators))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    sizes = np.diff(np.append(starts, n))
    rank[order] = np.repeat(starts, sizes)
    open_, step = order[np.repeat(sizes, sizes) > 1], 1
    while len(open_):
        # Suffixes of one group differ before the end: the sequence ends with a separator of its own.
        own, next_ = rank[open_], rank[np.minimum(open_ + step, n - 1)]
        by = np.lexsort((next_, own))
        open_, own, next_ = open_[by], own[by], next_[by]
        group = np.concatenate([[True], own[1:] != own[:-1]])
        part = group | np.concatenate([[True], next_[1:] != next_[:-1]])
        at = np.arange(len(open_))
        first, begin = at[group], at[part]
        rank[open_] = own + np.repeat(begin, np.diff(np.append(begin, len(at)))) - np.repeat(first, np.diff(np.append(first, len(at))))
        size = np.diff(np.append(begin, len(at)))
        open_ = open_[np.repeat(size, size) > 1]
        step *= 2
    return rank


class FMIndex:
    """Counts and locates word phrases by backward search through the ranks of a wavelet matrix."""

    def __init__(self, symbols: np.ndarray):
        """``symbols``: words from 1 on, in runs that each end with SEPARATOR."""
        n = len(symbols)
        rank = suffix_ranks(symbols)
        last = np.empty(n, dtype=np.uint32)
        last[rank] = np.roll(symbols, 1)
        self.matrix = WaveletMatrix.build(last)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1))])
        # Every 16th place and each run's first word are sampled, so a walk never passes a separator.
        places = np.flatnonzero((np.arange(n) % SAMPLE == 0) | (np.roll(symbols, 1) == SEPARATOR))
        marked = np.zeros(n, dtype=bool)
        marked[rank[places]] = True
        self.sampled = Plane.of(marked)
        self.places = places[np.argsort(rank[places])]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each phrase; ``phrases`` holds its symbols right-aligned."""
        width = phrases.shape[1]
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.matrix.size, dtype=np.int64)
        live = np.arange(len(phrases))
        for k in range(width):
            live = live[(sizes[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, width - 1 - k].astype(np.int64)
            known = symbol < len(self.before) - 1
            base = self.before[np.minimum(symbol, len(self.before) - 2)]
            low[live] = np.where(known, base + self.matrix.ranks(symbol, low[live]), 0)
            high[live] = np.where(known, base + self.matrix.ranks(symbol, high[live]), 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place of the suffix in each row, by walking back to a sampled one."""
        rows, found = rows.astype(np.int64), np.zeros(len(rows), dtype=np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            here = rows[todo]
            done = self.sampled.get(here).astype(bool)
            found[todo[done]] = self.places[self.sampled.rank(here[done])] + steps
            todo, here = todo[~done], here[~done]
            symbol = self.matrix.access(here).astype(np.int64)
            rows[todo] = self.before[symbol] + self.matrix.ranks(symbol, here)
            steps += 1
        return found
