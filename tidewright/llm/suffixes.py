"""Suffix arrays by induced sorting, and permuted longest common prefixes, in NumPy.

Both scans of induced sorting run over blocks: a block ends at the first place that is still to be filled, so
whatever stands in it is final, and all that it induces is placed at once. That keeps the scans linear and lets
arrays do the work, for bytes as for the names of the recursion.
"""

from __future__ import annotations

import numpy as np


def _grouped(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by value; sorted values, their rank among equals, first of each group, group sizes."""
    order = np.argsort(c, kind="stable")
    c = c[order]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    sizes = np.diff(np.concatenate((first, [len(c)])))
    return order, c, np.arange(len(c)) - np.repeat(first, sizes), first, sizes


def _induce(t: np.ndarray, s: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sort all suffixes from leftmost-smaller ones that are in order (or only by first letter)."""
    n = len(t)
    ends = np.cumsum(counts)
    starts = ends - counts
    larger = np.bincount(t[~s], minlength=len(counts))
    sa = np.full(n, -1, np.int64)
    order, c, rank, _, _ = _grouped(t[lms])
    sa[ends[c] - np.bincount(c, minlength=len(counts))[c] + rank] = lms[order]

    slots = np.repeat(starts + larger, counts)  # of each place, where its letter's smaller suffixes begin
    open_ = np.arange(n) < slots
    head, i, block = starts.copy(), 0, 1024
    while i < n:
        stop = min(n, i + block)
        j = int(open_[i:stop].argmax())
        e = i + j if open_[i + j] else stop
        found = sa[i:e]
        found = found[found > 0] - 1
        found = found[~s[found]]
        if len(found):
            order, c, rank, first, sizes = _grouped(t[found])
            at = head[c] + rank
            sa[at] = found[order]
            open_[at] = False
            head[c[first]] += sizes
        block = min(block * 2, 1 << 20) if e == stop else max(1024, 2 * (e - i))
        i = e

    open_ = np.arange(n) >= slots
    sa[0], open_[0] = n - 1, False
    tail, i, block = ends.copy(), n, 1024
    while i > 0:
        stop = max(0, i - block)
        j = int(open_[stop:i][::-1].argmax())
        e = i - j if open_[i - 1 - j] else stop
        found = sa[e:i][::-1]
        found = found[found > 0] - 1
        found = found[s[found]]
        if len(found):
            order, c, rank, first, sizes = _grouped(t[found])
            at = tail[c] - 1 - rank
            sa[at] = found[order]
            open_[at] = False
            tail[c[first]] -= sizes
        block = min(block * 2, 1 << 20) if e == stop else max(1024, 2 * (i - e))
        i = e
    return sa


def _sort(t: np.ndarray, letters: int) -> np.ndarray:
    """Suffix array of ``t``, whose last element is 0 and the only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(t[1:] - t[:-1])
    after = np.where(step != 0, np.arange(n - 1), n)
    after = np.minimum.accumulate(after[::-1])[::-1]
    s = np.concatenate((step[after] > 0, [True]))  # smaller than the suffix that follows
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    counts = np.bincount(t, minlength=letters)
    sa = _induce(t, s, lms, counts)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_first = sa[is_lms[sa]]
    size = np.zeros(n, np.int64)
    size[lms] = np.diff(np.concatenate((lms, [n])))
    a, b = by_first[:-1], by_first[1:]
    same = size[a] == size[b]
    same[:1] = False  # the sentinel
    live = np.flatnonzero(same)
    d = 0
    while len(live):
        differ = t[a[live] + d] != t[b[live] + d]
        same[live[differ]] = False
        live = live[~differ]
        live = live[size[a[live]] > d]
        d += 1
    names = np.concatenate(([0], np.cumsum(~same)))
    if names[-1] + 1 < len(lms):
        name_of = np.zeros(n, np.int64)
        name_of[by_first] = names
        by_first = lms[_sort(name_of[lms], int(names[-1]) + 1)]
    return _induce(t, s, by_first, counts)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffix array of an array of small non-negative integers, by induced sorting."""
    t = np.concatenate((np.asarray(data, np.int64) + 1, [0]))
    return _sort(t, int(t.max()) + 1)[1:]


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix of its suffix and the one before it in ``sa``.

    Compared are only positions whose left neighbours differ; each other one has its left neighbour's length less one.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    left = data[np.maximum(before - 1, 0)] != data[np.maximum(i - 1, 0)]
    at = np.flatnonzero((i == 0) | (before <= 0) | left)
    padded = np.concatenate((np.asarray(data, np.uint8), np.zeros(16, np.uint8)))
    eights = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    length = np.zeros(n, np.int64)
    live = at[before[at] >= 0]
    while len(live):
        p, q = live + length[live], before[live] + length[live]
        room = n - np.maximum(p, q)
        x = eights[np.minimum(p, n)] ^ eights[np.minimum(q, n)]
        equal = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8)
        equal = np.minimum(equal, room)
        length[live] += equal
        live = live[(equal == 8) & (room > 8)]
    source = np.zeros(n, np.int64)
    source[at] = at
    source = np.maximum.accumulate(source)
    return np.maximum(length[source] - (i - source), 0)
