"""Periodic runs of words: stretches that repeat with a smallest period, found as branching tandem repeats.

Words are runs of non-blank characters (blanks: U+0020, U+0009 to U+000D).  An enhanced suffix array (suffix array, its inverse,
LCP values) of a batch's words is enough: for each LCP interval of depth d the
suffixes of all children but the largest look up ISA[i + d] and ISA[i - d];
a hit in another child of the interval is a square of period d that no word extends to the right.
Rotating it to the left as far as the words agree gives the whole run, and
squares that end together with a multiple of a found period belong to that run.

A run of ``least`` words has equal words at a distance of its period in at least half of ``least`` consecutive
places, so each of its words lies in a window of that many words which the document holds twice.  Only such
words enter the suffix array; all others can't be in a run.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regioncast.llm.common import narrowed, slices, small_batches

RUN = "struct<start:long,length:long,period:long>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Suffixes of smaller children that are looked up at a time.
LOOKUPS = 1 << 20


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse, by prefix doubling over the suffixes whose order is still open."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    first = np.concatenate([[True], s[sa][1:] != s[sa][:-1]])
    rank, slots = np.empty(n, dtype=np.int64), np.arange(n)
    width = 0
    while True:
        rank[sa[slots]] = slots[np.flatnonzero(first)][np.cumsum(first) - 1]
        slots = slots[~(first & np.append(first[1:], True))]
        if not len(slots):
            return sa, rank
        width = 2 * width or 1
        at = sa[slots]
        after = at + width
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[slots], key = at[order], key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])


def lcp_values(s: np.ndarray, sa: np.ndarray, isa: np.ndarray) -> list[int]:
    """LCP of each suffix with the one before it in suffix order (0 for the first)."""
    words, before, ranks = s.tolist(), np.concatenate([[0], sa[:-1]])[isa].tolist(), isa.tolist()
    n, h = len(words), 0
    out = [0] * n
    for i, r in enumerate(ranks):
        if not r:
            h = 0
            continue
        j = before[i]
        end = n - max(i, j)
        while h < end and words[i + h] == words[j + h]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    return out


def _bounds(lcp: list[int]) -> tuple[list[int], list[int]]:
    """For each place of an LCP array, the next smaller value's place to its left and right (the array's ends: 0 and n)."""
    n = len(lcp)
    left, right = [0] * n, [n] * n
    stack: list[int] = []
    for k in range(n):
        v = lcp[k]
        while stack and lcp[stack[-1]] > v:
            right[stack.pop()] = k
        # an equal value shares the interval
        left[k] = (left[stack[-1]] if lcp[stack[-1]] == v else stack[-1]) if stack else 0
        stack.append(k)
    for k in range(n - 2, -1, -1):  # the last of equal values knows the right end
        if right[k] < n and lcp[right[k]] == lcp[k]:
            right[k] = right[right[k]]
    return left, right


def branching_squares(s: np.ndarray) -> np.ndarray:
    """Rows (end, period) of all squares w w in ``s`` whose period the next symbol doesn't continue, in ascending order."""
    n = len(s)
    if n < 2:
        return np.empty((0, 2), dtype=np.int64)
    sa, isa = suffix_array(s)
    values = lcp_values(s, sa, isa)
    left, right = (np.array(x, dtype=np.int64) for x in _bounds(values))
    lcp = np.array(values, dtype=np.int64)
    cuts = np.flatnonzero(lcp > 0)
    if not len(cuts):
        return np.empty((0, 2), dtype=np.int64)
    # an interval is [low, high); its cuts are the places where a child but the first begins
    low, high = left[cuts], right[cuts]
    order = np.lexsort((cuts, high, low))
    cuts, low, high = cuts[order], low[order], high[order]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    interval = np.cumsum(new) - 1
    lows, highs, depths = low[new], high[new], lcp[cuts[new]]
    of = np.concatenate([np.arange(len(lows)), interval])
    start = np.concatenate([lows, cuts])
    order = np.lexsort((start, of))
    of, start = of[order], start[order]
    last = np.append(of[1:] != of[:-1], True)
    end = np.where(last, highs[of], np.append(start[1:], 0))
    size = end - start
    heads = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    by_size = np.lexsort((-size, of))
    smaller = np.ones(len(of), dtype=bool)
    smaller[by_size[heads]] = False  # one largest child of each interval
    of, start, end, size = of[smaller], start[smaller], end[smaller], size[smaller]
    found = [np.empty((0, 2), dtype=np.int64)]
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + LOOKUPS, side="right")))
        child = np.repeat(np.arange(at, to), size[at:to])
        place = start[child] + np.arange(len(child)) - (ends[child] - size[child] - before)
        i, d, g = sa[place], depths[of[child]], of[child]
        for j, square in ((i + d, i), (i - d, i - d)):
            inside = (j >= 0) & (j < n)
            r = isa[np.where(inside, j, 0)]
            hit = inside & (r >= lows[g]) & (r < highs[g]) & ((r < start[child]) | (r >= end[child]))
            found.append(np.stack([square[hit] + 2 * d[hit], d[hit]], axis=1))
        at = to
    return np.unique(np.concatenate(found), axis=0)


def _start(s: np.ndarray, end: int, period: int) -> int:
    """The first symbol of the run of that end and period: its last square, rotated to the left while the symbols agree."""
    at, step = end - 2 * period, 16
    while at > 0:
        lo = max(0, at - step)
        same = s[lo:at] == s[lo + period:at + period]
        if not same.all():
            return lo + int(np.flatnonzero(~same)[-1]) + 1
        at, step = lo, 2 * step
    return at


def runs(s: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of ``s`` of at least ``least`` symbols and two periods, in ascending order."""
    out, here, last = [], [], -1
    for end, period in branching_squares(s).tolist():
        if end != last:
            here, last = [], end
        if any(period % p == 0 and start <= end - 2 * period for start, p in here):
            continue  # a multiple of a smaller period of the same run
        start = _start(s, end, period)
        here.append((start, period))
        if end - start >= least:
            out.append((start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _covered(s: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that their document holds twice (by a hash, so a few others too)."""
    out = np.zeros(len(s), dtype=bool)
    n = len(s) - width + 1
    if n < 2:
        return out
    key = doc[:n].astype(np.uint64)
    for k in range(width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + s[k:k + n].astype(np.uint64) + np.uint64(1)
        key ^= key >> np.uint64(29)
    at = np.flatnonzero(doc[:n] == doc[width - 1:])
    at = at[np.argsort(key[at], kind="stable")]
    same = key[at][1:] == key[at][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = at[twice]
    depth = np.zeros(len(s) + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + width, -1)
    return np.cumsum(depth[:-1]) > 0


def runs_of_documents(words: list[np.ndarray], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, given as symbols; one suffix array for all of them."""
    out: list[list] = [[] for _ in words]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    if not sizes.sum():
        return out
    s, doc = np.concatenate(words), np.repeat(np.arange(len(words)), sizes)
    begin = np.cumsum(sizes) - sizes
    keep = np.flatnonzero(_covered(s, doc, -(-least // 2)))
    if not len(keep):
        return out
    # stretches of covered words, each closed by a symbol of its own
    cut = np.flatnonzero((np.diff(keep) != 1) | (np.diff(doc[keep]) != 0)) + 1
    symbols = np.insert(s[keep], np.append(cut, len(keep)), s.max() + 1 + np.arange(len(cut) + 1))
    origin = np.insert(keep, np.append(cut, len(keep)), -1)
    for start, length, period in runs(symbols, least):
        d = doc[origin[start]]
        out[d].append((int(origin[start] - begin[d]), length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word stands at each of ``n`` places of a document whose id's crc32 is divisible by ten: from a place
    on the words repeat, place and period by the id.  None for all other documents."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words are in no run after its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def periodic_runs(docs: DataFrame, least: int = 12, plant: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed): all runs of each document's words, by start and period, and the text left when
    each run keeps its first period only (its words joined by a blank).

    A run has at least ``least`` words and two periods, its period is the smallest, and no neighbouring word extends it.  With
    ``plant`` the words are first rearranged by `planted`.  Null, empty and blank texts have no words, no runs and an empty
    rest.  Each row is a document of its own, whatever its id: equal rows give equal rows, a row with a null id is never
    rearranged.  A text of any length is one document; extra columns are ignored; no rows give no rows.
    """
    small_batches(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            number = defaultdict(count().__next__)
            ids = batch.column("doc_id").to_pylist()
            texts, symbols = [], []
            for doc_id, text in zip(ids, batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                at = planted(len(words), doc_id) if plant else None
                symbol = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
                if at is not None:
                    words, symbol = [words[i] for i in at.tolist()], symbol[at]
                texts.append(words)
                symbols.append(symbol)
            found = runs_of_documents(symbols, least)
            rest = [b" ".join([w for w, k in zip(words, _kept(len(words), got).tolist()) if k] if got else words)
                    for words, got in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in got] for got in found], pa.list_(_RUN)),
                 pa.array([r.decode() for r in rest], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return narrowed(docs, doc_id="long", text="string").mapInArrow(
        find, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")
