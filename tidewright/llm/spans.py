"""Leftmost non-overlapping matches, and digests of the spans found.

A span is ``(start, end, kind)`` in code points, end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Callable, Iterable

Span = tuple[int, int, str]


def matches(pattern, text: str, kind: str, passes: Callable) -> list[Span]:
    """Matches that pass; one that fails is dropped and not tried again in another way."""
    return [(*m.span(), kind) for m in pattern.finditer(text) if passes(m)]


def by_start(kinds: tuple[str, ...]) -> Callable[[Span], tuple]:
    rank = {k: i for i, k in enumerate(kinds)}
    return lambda s: (s[0], rank[s[2]], s[1])


def by_kind(kinds: tuple[str, ...]) -> Callable[[Span], tuple]:
    rank = {k: i for i, k in enumerate(kinds)}
    return lambda s: (rank[s[2]], s[0], s[1])


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


class Cover:
    """Spans by start, for quick questions about a stretch."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []  # the greatest end of all spans up to this one
        for start, end, _ in sorted(spans):
            self.starts.append(start)
            self.ends.append(max(end, self.ends[-1]) if self.ends else end)

    def overlaps(self, start: int, end: int) -> bool:
        """Whether a span shares a character with the stretch."""
        k = bisect.bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start

    def contains(self, start: int, end: int) -> bool:
        """Whether one span equals or contains the stretch."""
        k = bisect.bisect_right(self.starts, start)
        return k > 0 and self.ends[k - 1] >= end
